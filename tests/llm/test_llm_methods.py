"""Signatures, links, likeness and the streaming search held against plain versions."""

import collections
import random

import numpy as np
import pytest

from gridspark.llm import exact_dedup, fingerprints, jaccard_join, sentence_pieces, sharding, substring_dedup
from test_llm_copies import ODD, WORD, made_up


def random_set(rng, n):
    return np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))


@pytest.mark.parametrize("percent,n", [(80, 40), (80, 150), (80, 400), (90, 60), (90, 150)])
def test_unrelated_sets_share_no_signature(percent, n):
    rng = np.random.default_rng(n)
    steps = jaccard_join.size_steps(percent, 1024)
    marks = np.concatenate([np.unique(jaccard_join.signatures(random_set(rng, n), percent, steps)) for _ in range(2000)])
    assert len(np.unique(marks)) == len(marks)


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    steps = jaccard_join.size_steps(percent, 1024)
    for n in (1, 2, 4, 9, 30, 150, 500):
        for _ in range(40):
            one = random_set(rng, n)
            apart = int(2 * n * (100 - percent) / (100 + percent))
            gone = int(rng.integers(0, apart + 1))
            while 100 * (n - gone) < percent * (n + apart - gone):
                apart -= 1
                gone = min(gone, apart)
            other = np.sort(np.concatenate([rng.permutation(one)[gone:], random_set(rng, apart - gone)]))
            if len(other):
                assert np.intersect1d(*(jaccard_join.signatures(x, percent, steps) for x in (one, other))).size


def links_by_hand(rows, size, percent):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append(frozenset({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else ())))
    pairs, others = set(), collections.Counter()
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                others[a] += 1
                others[b] += 1
                if sets[a] != sets[b]:
                    pairs.add(frozenset({sets[a], sets[b]}))
    return len(pairs), sorted(((i, len(sets[k]), others[k]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("seed,size,percent,region", [(1, 3, 90, 512), (2, 5, 80, 512), (3, 1, 50, 512), (4, 5, 80, 3)])
def test_all_links_agree_with_brute_force(table, stored, monkeypatch, seed, size, percent, region):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", region)
    rows = made_up(seed, n=70) + ODD
    pairs, members = jaccard_join.all_links(stored(table(rows)), size, percent)
    got = sorted(((r.doc_id, r.n_shingles, r.n_links) for r in members.collect()), key=repr)
    assert (pairs.count(), got) == links_by_hand(rows, size, percent)
    names = {r.class_id for r in members.collect()}
    assert all(r.class_a < r.class_b and {r.class_a, r.class_b} <= names for r in pairs.collect())


def test_all_links_of_an_empty_table(table, stored):
    pairs, members = jaccard_join.all_links(stored(table([])))
    assert pairs.count() == members.count() == 0


def like(a, b):
    return fingerprints.likeness(*(fingerprints.fingerprint(fingerprints.points(x)) for x in (a, b)))


def spans_by_hand(a, b):
    """Share of the longer text by distinct spans of both, wherever they stand."""
    one, other = ({x[i:i + fingerprints.SPAN] for i in range(len(x) - fingerprints.SPAN + 1)} for x in (a, b))
    return min(len(one & other) * (len(a) + len(b)) / max(1, len(one) + len(other)), len(a), len(b)) / max(len(a), len(b))


def test_likeness_sees_the_middle_of_texts():
    rng = random.Random(7)
    new = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    for n in (1000, 3000, 6000):
        a = new(n)
        assert like(a, "0123456789" + a[10:-10] + "9876543210") >= 0.9
        assert like(a, a[1:]) >= 0.9 and like(a, "x" + a) >= 0.9 and like(a, a[5:] + new(5)) >= 0.9
        assert like(a, new(n)) <= 0.1
        for part in (0.2, 0.5, 0.8):
            inside = a[int(n * part / 3):int(n * part / 3 + n * part)]
            b = new((n - len(inside)) // 2) + inside + new((n - len(inside)) // 2)
            assert abs(like(a, b) - spans_by_hand(a, b)) < 0.25
    assert like("", "") == 1 and like("", "abc") == 0 and like("x" * 50, "x" * 5000) <= 0.01 and like("abc", "abd") < 1


def test_short_spans_are_polynomials():
    values = fingerprints.points("Größe 12, ½ \U0010ffff" * 20)
    got = fingerprints.Prefixes(values).short_spans(16)
    prime, base = fingerprints.PRIMES[0], fingerprints.BASES[0]
    assert got.tolist() == [sum((int(v) + 1) * pow(base, k, prime) for k, v in enumerate(values[i:i + 16])) % prime for i in range(len(values) - 15)]
    assert len(fingerprints.Prefixes(values[:15]).short_spans(16)) == 0


def test_ids_come_from_the_streaming_search(monkeypatch):
    import sentencepiece

    path = sentence_pieces.default_path()
    model, library = sentence_pieces.load(path), sentencepiece.SentencePieceProcessor(model_file=path)
    seen, width = [], []
    stream, meeting = model.stream, model.meeting

    def counted(chunks):
        out = list(stream(chunks))
        seen.append("".join(out))
        return iter(out)

    def bounded(ways, at):
        width.append(len(ways))
        return meeting(ways, at)

    monkeypatch.setattr(model, "stream", counted)
    monkeypatch.setattr(model, "meeting", bounded)
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdeé中 ") for _ in range(300)) for _ in range(20)] + ["long" * 2000]
    for text in texts:
        assert model.encode(text).tolist() == library.encode(text)
    parts = {p for t in texts for p in model.segment.findall("▁" + t.replace(" ", "▁"))}
    assert set(seen) == parts
    assert width and max(width) <= 6 * model.longest


def test_neighbours_that_stay():
    model = sentence_pieces.load(sentence_pieces.default_path())
    rng = random.Random(9)
    pieces = [p for p in model.ids if len(p) < 12]
    for _ in range(5000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        assert model.stays(a, b) == (model.merged(a + b) == [a, b])


def test_users_columns_with_clashing_names_stay(spark, table, stored, tmp_path):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"{passage} one"), (2, f"two {passage}"), (3, "three"), (3, "three")]
    df = stored(table(rows).selectExpr("*", "'mine' AS __row_no", "'own' AS __text"))
    for out in (exact_dedup.deduplicate(df), jaccard_join.keep_first(df), substring_dedup.remove(df)):
        assert out.columns == df.columns
        assert {(r["__row_no"], r["__text"], r.row_no) for r in out.collect()} == {("mine", "own", 1)}
    sharding.write_shards(df, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {(r["__row_no"], r.row_no) for r in back.collect()} == {("mine", 1)}
