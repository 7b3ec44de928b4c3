import zlib
from collections import Counter

import pytest

from silvertide.llm import queries, slots


def test_rows_sizes_and_places(spark, documents):
    rows = [(i, "x" * (i % 97 * 40)) for i in range(3000)] + [(None, None), (None, ""), (5, "é" * 7), (5, "é" * 7)]
    got = slots.shard_documents(documents(rows)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    places = {}
    for r in got:
        places.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(places) == set(range(16))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.02 * min(loads.values())
    assert len({(r.virtual_slot, r.shard) for r in got}) == len({r.virtual_slot for r in got})


def test_a_third_of_the_rows_with_one_text_is_spread(spark, documents):
    rows = [(i, "same words again" if i % 3 == 0 else f"text {i}" * 3) for i in range(2000)]
    loads = Counter()
    for r in slots.shard_documents(documents(rows)).collect():
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.05 * min(loads.values())


def test_reruns_agree_and_empty_tables_give_nothing(spark, documents):
    rows = [(i, f"t{i}") for i in range(300)]
    key = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.collect())
    assert key(slots.shard_documents(documents(rows))) == key(slots.shard_documents(documents(rows[::-1]).repartition(5)))
    assert slots.shard_documents(documents([])).count() == 0


def test_map_versions(spark, tmp_path):
    sizes = [(s * 7919) % 1000 + 1 for s in range(slots.SLOTS)]
    one = slots.first_map(sizes)
    assert max(one.loads(sizes)) - min(one.loads(sizes)) <= 2
    more = [s * (3 if k % 16 == 0 else 1) for k, s in enumerate(sizes)]
    two = slots.rebalanced(one, more)
    assert two.version == 2 and max(two.loads(more)) <= 1.01 * sum(more) / 16
    moved = sum(a != b for a, b in zip(one.shard_of, two.shard_of, strict=True))
    assert moved < slots.SLOTS / 4
    three = slots.grown(two, more)
    assert three.shards == 17 and all(b in (a, 16) for a, b in zip(two.shard_of, three.shard_of, strict=True))
    assert abs(three.loads(more)[16] / (sum(more) / 17) - 1) < 0.01
    slots.save_map(spark, one, str(tmp_path))
    slots.save_map(spark, three, str(tmp_path))
    assert slots.load_map(spark, str(tmp_path), 3) == three and slots.load_map(spark, str(tmp_path), 1) == one
    assert slots.load_map(spark, str(tmp_path)) == three and slots.load_map(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileExistsError):
        slots.save_map(spark, one, str(tmp_path))


def test_one_record_as_a_third_of_the_table_is_spread(spark, documents):
    rows = [(None, "the same record " * 20)] * 1000 + [(i, f"text {i} " * 40) for i in range(2000)]
    got = slots.shard_documents(documents(rows).repartition(7)).collect()
    loads, places, per_slot = Counter(), {}, Counter()
    for r in got:
        loads[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
        per_slot[r.virtual_slot] += 1
    assert len(got) == 3000 and max(loads.values()) <= 1.05 * min(loads.values()) and len(loads) == 16
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and max(per_slot.values()) < 12


def test_more_copies_than_slots(spark, documents):
    rows = [(7, "copy")] * 1000 + [(8, "other")] * 3
    found = slots.slotted(documents(rows), slots=64).collect()
    assert Counter({d: sum(r.n for r in found if r.doc_id == d) for d in (7, 8)}) == {7: 1000, 8: 3}
    assert len([r for r in found if r.doc_id == 7]) == 64 and {r.n for r in found if r.doc_id == 7} == {15, 16}
    got = slots.shard_documents(documents(rows), shards=4, slots=64).collect()
    assert Counter(r.doc_id for r in got) == {7: 1000, 8: 3}
    for shard in range(4):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))


def test_a_stored_map_is_used_and_edited(spark, documents, tmp_path):
    maps = str(tmp_path / "maps")
    first = [(i, "x" * (i % 50 * 20 + 10)) for i in range(4000)]
    run = lambda rows, shards=16: {r.doc_id: r for r in slots.shard_documents(documents(rows), shards, maps=maps).collect()}
    one, again = run(first), run(first)
    assert one == again and {r.map_version for r in one.values()} == {1}
    # A third more rows, all of them in some slots: only what must move does.
    more = run([(i, t * (4 if one[i].virtual_slot % 16 == 0 else 1)) for i, t in first])
    assert {r.map_version for r in more.values()} == {2}
    edited, old = slots.load_map(spark, maps), slots.load_map(spark, maps, 1)
    moved = [s for s in range(slots.SLOTS) if edited.shard_of[s] != old.shard_of[s]]
    assert 0 < len(moved) < slots.SLOTS / 4
    loads = Counter()
    for r in more.values():
        loads[r.shard] += r.size
        assert r.shard == edited.shard_of[r.virtual_slot]
    assert max(loads.values()) <= 1.03 * min(loads.values())
    grown = run(first, 17)
    assert {r.map_version for r in grown.values()} == {3} and slots.load_map(spark, maps).shards == 17
    with pytest.raises(ValueError):
        run(first, 16)


def test_the_query_stores_its_map(spark, sf_dir):
    first = queries.op7_virtual_slots(spark, sf_dir)
    again = queries.op7_virtual_slots(spark, sf_dir)
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "text_crc32", "shard", "slot", "map_version").collect()))
    assert rows(first) == rows(again)
