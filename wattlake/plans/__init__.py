"""Multi-step jobs: layer builds, model runs and report bundles."""
