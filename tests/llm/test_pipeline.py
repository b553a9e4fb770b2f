"""The pipeline: its stages in order, each on all its predecessor kept, and the registered queries."""

import collections
import random

from tokenizers import Tokenizer

import corpus_pipeline
import wattlake.llm.queries as queries
from wattlake.llm.minhash import near_duplicates
from wattlake.llm.mixing import mix_sources
from wattlake.llm.packing import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "minhash near-dedup", "mixing", "packing"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], SF)
        kept.append(spark.createDataFrame(out.collect(), out.schema))
    raw, good, clean, single, mixed, packed = kept
    assert all(k.columns == docs.columns for k in kept[:-1])
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert ids[1] < ids[0] and ids[2] == ids[1] and ids[3] <= ids[2] and ids[4] <= ids[3] and ids[5] == ids[4]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = ids[0] - ids[1]
    assert not [i for i in gone if labels.get(i) == 1] and len([i for i in ids[1] if labels.get(i) == 0]) <= 1
    assert near_duplicates(single).where("NOT kept").count() == 0
    taken = {r["doc_id"]: r["taken"] for r in mix_sources(single).collect()}
    words = collections.Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len([w for w in r["text"].replace("\x0b", " ").split() if w])
    assert dict(words) == {i: t for i, t in taken.items() if t}
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_registered_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, clashing names: each stage against a plain version."""
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau", "phi", "chi"]) + str(rng.randint(0, 99)) for _ in range(n))
    long, base = text(3000), text(60)
    rows = [(1, None, "a"), (2, "", "a"), (3, base, "a"), (4, base + " end", None), (None, text(20), "b"), (None, text(20), "b"), (6, long, "b")]
    rows += [(7, text(30), "b")] * 10 + [(8, "Same line\nown " + text(12), "a")] * 2 + [(20 + i, f" same line \n{text(15)}", "a") for i in range(12)]
    rows += [(40, text(10), "b"), (40, text(11), "b")]
    names = ["_gone", "_copy", "_row", "_taken", "_size", "_id", "n_lines", "n_dropped", "size", "taken", "n", "_place", "_again"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], schema).repartition(3)
    plain = lambda df: collections.Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.select(*names).distinct().collect() in ([tuple(range(len(names)))], [])
        assert stage(spark, docs.limit(0), SF).count() == 0
    lined = plain(corpus_pipeline.line_dedup(spark, docs, SF))
    want = collections.Counter()
    for d, t, s in rows:
        want[d, "\n".join(x for x in (t or "").split("\n") if x.strip().lower() != "same line"), s] += 1
    assert lined == want
    single = plain(corpus_pipeline.near_dedup(spark, docs, SF))
    ids = sorted({d for d, _, _ in rows if d is not None})
    texts = {d: min(t or "" for x, t, _ in rows if x == d) for d in ids}
    kept = {d for d in ids if not any(e < d and texts[e].split() and texts[d].split() and jaccard(texts[e], texts[d]) >= 0.8 for e in ids)}
    assert 3 in kept and 4 not in kept
    assert collections.Counter(d for d, _, _ in single.elements()) == collections.Counter([*kept, None, None])
    for documents in (docs, docs.where("doc_id = 7")):
        taken = collections.Counter()
        for r in mix_sources(documents).collect():
            taken[r["source"]] += r["taken"]
        written = collections.Counter()
        for (_, t, s), n in plain(corpus_pipeline.mixing(spark, documents, SF)).items():
            written[s] += n * len(t.split())
        assert +taken == written
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 1), (7, 1), (40, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    docs_now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = stage(spark, docs_now, str(tmp_path))
        docs_now = spark.createDataFrame(docs_now.collect(), docs_now.schema)
    assert packed.groupBy("doc_id").agg({"length": "sum"}).count() == docs_now.select("doc_id").distinct().count()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    count = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs_now.collect())
    assert packed.agg({"length": "sum"}).first()[0] == count


def test_no_tables_left_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert corpus_pipeline.line_dedup(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).count() == 200
    assert {t.name for t in spark.catalog.listTables()} == before
