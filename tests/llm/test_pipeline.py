import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from silvertide.llm import mixing, simhash, toxicity
from silvertide.llm.simhash import fingerprints


def components(prints):
    """doc_id: smallest doc_id reachable by links of at most four bits."""
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in ids}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def windows_hit(text, items):
    own = " " + " ".join(words(text)) + " "
    for item in items:
        w = words(item)
        n = min(10, len(w))
        if n and any(f" {' '.join(w[i : i + n])} " in own for i in range(len(w) - n + 1)):
            return True
    return False


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontaminate", "mix", "shard"]
    rejected = {r.doc_id for r in toxicity.toxicity_report(docs, labels).collect() if r.predicted}
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs.collect(), stage(spark, docs, sf_dir)
        after = out.collect()
        ids = Counter(r.doc_id for r in after)
        if name != "shard":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert set(after) <= set(before)
        if name == "toxicity":
            assert set(ids) == {r.doc_id for r in before} - rejected
        elif name == "near_dedup":
            prints = {r.doc_id: r.fp & (2**64 - 1) for r in fingerprints(docs).collect()}
            assert set(ids) == set(components(prints).values())
        elif name == "decontaminate":
            assert set(ids) == {r.doc_id for r in before if not windows_hit(r.text, benchmark)}
        elif name == "mix":
            want = {r.doc_id: r.taken // r.size for r in mixing.mix_documents(docs).collect() if r.taken}
            assert ids == Counter(want)
        else:
            assert sum(ids.values()) == len(before)
            places = {}
            for r in after:
                places.setdefault(r.shard, []).append(r.slot)
            assert all(sorted(p) == list(range(len(p))) for p in places.values())
        docs = spark.createDataFrame(after, out.schema)


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "shard", "slot"} <= set(out.columns) and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows_pass_through(spark, documents, tmp_path):
    rows = [(1, None), (2, ""), (None, "a b c"), (None, "a b c"), (3, "x y " * 40, None), (4, "long " * 60_000), (4, "long " * 60_000), (5, "p q r s t u v w")]
    folder = str(tmp_path)
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    # Without labels nothing is toxic. Null and empty texts are one group, the two null ids one row, the two long texts one row.
    rates = {r.toxicity for r in toxicity.score(documents(rows), toxicity.fit(documents(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))).collect()}
    assert max(rates) < toxicity.THRESHOLD
    singles = [rows[0], rows[2], rows[4], rows[5], rows[7]]
    left = simhash.representatives(documents(rows))
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((d, t) for d, t, *_ in singles)
    # Nothing is contaminated; a source with one text gets it as often as its target has room for.
    want = Counter({r.doc_id: r.taken // r.size for r in mixing.mix_documents(left).collect() if r.taken})
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in got) == want and sum(want.values()) > 0 and 1 not in want
    texts = {d: t for d, t, *_ in singles}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 for r in got)
    none = str(tmp_path / "none")
    documents([]).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{none}/benchmark.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0


def test_columns_with_names_of_the_stages_keep_their_values(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = ["toxicity", "evidence", "text_mark", "kept_id", "kept_mark", "n_words", "Hit_Ranges", "row_mark", "place", "taken_id", "taken_twice", "turn", "a.b"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, sf_dir)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stage(spark, docs, sf_dir).select("doc_id").collect()), name
    assert corpus_pipeline.place_in_shards(spark, wide, sf_dir).count() == docs.count()
