"""Exact dedup, sharding, substring dedup and the Jaccard join against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from gridspark.llm import exact_dedup, jaccard_join, sharding, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# A null and an empty text, blanks alone, repeated rows and ids, null ids.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a  b"), (5, "a b"), (5, "a b"), (None, "a\tb"), (None, None), (7, "é " * 50), (8, "x" * 200_000)]


def made_up(seed, n=60, vocabulary=40, longest=220):
    """Texts that share passages, copies and near copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Und", "the,", "ß"]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for i in range(n):
        kind = rng.random()
        own = [rng.choice(words) for _ in range(rng.randint(0, longest))]
        if kind < 0.2 and texts:
            own = list(rng.choice(texts))
        elif kind < 0.5 and texts:
            own = list(rng.choice(texts))
            for _ in range(rng.randint(1, 6)):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(words)
        elif kind < 0.7:
            at = rng.randint(0, len(own))
            own[at:at] = passage[rng.randint(0, 10):]
        elif kind < 0.75:
            own = ["so"] * rng.randint(30, 90)
        texts.append(own)
    return [(i, rng.choice([" ", "\n", "  "]).join(t)) for i, t in enumerate(texts)]


def test_exact_dedup_keeps_the_smallest_id(table, stored):
    rows = stored(table(ODD))
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.decide(rows).collect()}
    empty, one = (hashlib.sha256(x).hexdigest() for x in (b"", b"a b"))
    assert got[2, empty].keep_id == 1 and got[1, empty].kept and got[None, empty].group_size == 3
    assert got[4, one].kept and got[None, one].keep_id == 4 and got[5, one].group_size == 4
    assert exact_dedup.decide(rows).count() == len(ODD)
    kept = exact_dedup.deduplicate(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 7, 8]


@pytest.mark.parametrize("support", [0.5, 0.01, 1e-4])
def test_exact_dedup_is_the_same_with_and_without_heavy_hitters(table, stored, support):
    rows = [(i, f"t{i}" if i % 3 else "hot") for i in range(300)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.decide(stored(table(rows)), support).collect()}
    assert all(got[i] == ((i, 1) if i % 3 else (0, 100)) for i in range(300))


def test_exact_dedup_of_repeated_rows_keeps_one(table, stored):
    rows = stored(table([(5, "same")] * 7 + [(None, "none")] * 3))
    got = exact_dedup.decide(rows)
    assert got.filter("kept").count() == 2 and got.count() == 10
    assert exact_dedup.deduplicate(rows).count() == 2


def test_sharding_is_a_permutation_with_gapless_slots(table, stored):
    rows = ODD + [(100 + i, "t" * i) for i in range(91)]
    df = stored(table(rows))
    got = sharding.assign(df, bucket_bytes=500, bucket_rows=7).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(by) == list(range(8)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    expected = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted((r.size, r.text_crc32) for r in got) == expected
    assert [tuple(r) for r in sharding.assign(df).orderBy("row_no").collect()] == [tuple(r) for r in sharding.assign(df).orderBy("row_no").collect()]


def test_shards_are_written_with_all_rows(spark, table, stored, tmp_path):
    df = stored(table([(i, f"text {i}") for i in range(40)]))
    sharding.write_shards(df, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.text for r in back.collect()) == sorted(f"text {i}" for i in range(40))
    assert {r["count"] for r in back.groupBy("__shard").count().collect()} == {5}


def removed_by_hand(rows, window):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    count = collections.Counter(tuple(w[k:k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 35), (4, 8), (5, 30)])
def test_substring_dedup_agrees_with_brute_force(table, stored, seed, window):
    rows = made_up(seed) + [(1000 + k, t) for k, (_, t) in enumerate(ODD)]
    got = sorted((tuple(r) for r in substring_dedup.report(stored(table(rows)), window).collect()), key=repr)
    assert got == removed_by_hand(rows, window)


def test_substring_removal_keeps_white_space_and_other_columns(table, stored):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"One\n\n{passage}\tend  here"), (2, f"{passage} two"), (3, "clean\n text  stays"), (None, None)]
    df = stored(table(rows))
    got = substring_dedup.remove(df)
    assert got.columns == df.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {
        1: ("One\n\nend  here", 14), 2: ("two", 3), 3: ("clean\n text  stays", 18), None: (None, 0)}


def linked_by_hand(rows, size, percent):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return sorted(((i, len(sets[k]), min(least[find(k)], default=None)) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 5, 80), (3, 3, 80), (4, 1, 50), (5, 5, 80)])
def test_jaccard_join_agrees_with_brute_force(table, stored, seed, size, percent):
    rows = made_up(seed, n=90) + ODD
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.groups(stored(table(rows)), size, percent).collect()), key=repr)
    assert got == linked_by_hand(rows, size, percent)


def test_jaccard_join_in_blocks_agrees_with_brute_force(table, stored, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", 3)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(own)))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.groups(stored(table(rows)), 3, 80).collect()), key=repr)
    assert got == linked_by_hand(rows, 3, 80)


def test_jaccard_join_never_gathers_a_large_region(table, stored, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", 3)
    whole = jaccard_join.nearer

    def bounded(percent):
        def near(batches):
            held = list(batches)
            assert all(members.num_rows <= 12 for _, members in jaccard_join.runs_of(iter(held)))
            yield from whole(percent)(iter(held))

        return near

    monkeypatch.setattr(jaccard_join, "nearer", bounded)
    rng = random.Random(10)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1:])) for i in range(40) for k in [rng.randrange(110, 120)]] + made_up(6, n=20)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.groups(stored(table(rows)), 3, 80).collect()), key=repr)
    assert got == linked_by_hand(rows, 3, 80)


def test_keep_first_leaves_one_row_of_each_group(table, stored):
    near = [" ".join(f"w{i}" for i in range(100)), " ".join([f"w{i}" for i in range(99)] + ["other"])]
    df = stored(table([(9, near[0]), (4, near[1]), (4, near[1]), (6, "else"), (7, None), (8, "")]))
    kept = jaccard_join.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [4, 6, 7, 8]


def test_empty_tables(table, stored):
    none = stored(table([]))
    assert exact_dedup.decide(none).count() == sharding.assign(none).count() == 0
    assert substring_dedup.report(none).count() == jaccard_join.groups(none).count() == 0
    assert substring_dedup.remove(none).count() == jaccard_join.keep_first(none).count() == exact_dedup.deduplicate(none).count() == 0
