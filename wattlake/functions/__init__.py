"""Column functions: rounding, banding, scoring and labelling. All run inside codegen."""
