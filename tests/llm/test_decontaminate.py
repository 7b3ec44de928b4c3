import hashlib
import random
import re

from pyspark.sql import functions as F

from silvertide.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i : i + n]), []).append(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                if occurs := windows.get(tuple(own[i : i + n])):
                    hit.update(range(i, i + n))
                    found.update(str(x) for x in occurs if x is not None)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(found), digest, bool(hit)))
    return out


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = ["Über", "été", "x", "y1", "z", "The", "cat", "sat", "on", "mat"] + ["w%d" % i for i in range(60)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([1, 3, 9, 10, 11, 30, 60])))) for i in range(30)] + [(90, None), (91, ""), (92, "..."), (3, "x y z " * 9), (None, "the cat sat on mat"), (None, "Über y1 z")]
    docs = []
    for i in range(120):
        text = say(rng.choice([0, 2, 9, 30, 200]))
        for _ in range(rng.randrange(3)):
            own = words(rng.choice(items)[1])
            a = rng.randrange(len(own) + 1)
            text[rng.randrange(len(text) + 1) : 0] = own[a : a + rng.randrange(5, 40)]
        docs.append((i, rng.choice([" ", "\n", ", ", "-"]).join(text)))
    return docs + [(200, None), (201, ""), (202, "x" * 300_000), (203, ("cat " * 20_000) + "x y z x y z x y z x"), (7, docs[7][1])], items


def check(spark, documents, docs, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    if options:
        marked = decontaminate.decontaminate(documents(docs), benchmark, **options)
        got = [(r.doc_id, r.n_words, sum(x.end - x.begin for x in r.hit_ranges), r.hit_items) for r in marked.collect()]
        wanted = [(d, n, h, k) for d, n, h, k, _, _ in brute(docs, items)]
        assert sorted((a, b, c, len(d)) for a, b, c, d in got) == sorted(wanted) and all(r[3] == sorted(set(r[3])) for r in got)
    else:
        got = decontaminate.contamination_report(documents(docs), benchmark).collect()
        assert sorted(map(tuple, got)) == sorted(brute(docs, items))


def test_report_equals_brute_force(spark, documents):
    docs, items = fixture(1)
    check(spark, documents, docs, items)


def test_repeated_and_missing_item_ids_equal_sql(spark, documents):
    import duckdb

    from silvertide.llm.oracle import OP10

    docs, items = fixture(3)
    items += [(5, items[5][1]), (5, items[6][1]), (None, items[7][1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    wanted = sorted(con.execute(OP10).fetchall())
    assert wanted == sorted(brute(docs, items))
    check(spark, documents, docs, items)


def test_blocks_give_what_one_index_gives(spark, documents):
    docs, items = fixture(2)
    check(spark, documents, docs, items, block_bytes=300)


def test_a_large_benchmark_is_joined(spark, documents):
    docs, items = fixture(4)
    items += [(5, items[5][1]), (400, "Über été " * 30), (401, "x " + "Über été " * 30)]
    docs += [(300 + i, "same copy " + " ".join(words(items[4][1])) + " Über été" * 20) for i in range(60)]
    docs += [(500, items[6][1]), (500, items[6][1])]
    check(spark, documents, docs, items, block_bytes=0)
    check(spark, documents, docs, items)


def test_a_full_sieve_loses_nothing(spark, documents):
    docs, items = fixture(5)
    benchmark = spark.createDataFrame([(str(i), t) for i, t in items if t is not None], "item_id string, text string")
    got = decontaminate._joined(documents(docs), benchmark, sieve_bits=1 << 15).collect()
    wanted = sorted((d, n, h, k) for d, n, h, k, _, _ in brute(docs, items))
    assert sorted((r.doc_id, r.n_words, sum(x.end - x.begin for x in r.hit_ranges), len(r.hit_items)) for r in got) == wanted


def test_the_join_reads_documents_once_a_pass(spark, documents, tmp_path):
    docs, items = fixture(6)
    documents(docs).write.parquet(str(tmp_path / "docs"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.decontaminate(spark.read.parquet(str(tmp_path / "docs")), benchmark, block_bytes=0)
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join LeftOuter" in plan


def test_empty_tables_and_clashing_columns(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(documents([]), none).count() == 0
    row = decontaminate.contamination_report(documents([(1, "a b c")]), none).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)
    named = documents([(1, "a b c d e f g h i j k")]).withColumn("n_words", F.lit(-5)).withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame([(4, "b c d e f g h i j k l m")], "item_id long, text string")
    row = decontaminate.decontaminate(named, items).first()
    assert (row.n_words, row.hit_items, row.item_id, row.hit_ranges[0].begin, row.hit_ranges[0].end) == (11, ["4"], "x", 1, 11)
    named = named.withColumn("text_key", F.lit("own")).withColumn("list_id", F.lit("own"))
    row = decontaminate.decontaminate(named, items, block_bytes=0).first()
    assert (row.n_words, row.hit_items, row.item_id, row.hit_ranges[0].begin, row.hit_ranges[0].end) == (11, ["4"], "x", 1, 11)
    assert (row.text_key, row.list_id) == ("own", "own")
    assert decontaminate.decontaminate(documents([]), items, block_bytes=0).count() == 0
