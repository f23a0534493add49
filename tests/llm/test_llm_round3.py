"""Line rules, hard negatives and tokenizer alignment against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.llm import hard_negatives, line_rules, tokenizer_alignment
from gridspark.llm.queries import QUERIES

ODD = [(1, None), (2, ""), (3, " \t\n\v"), (4, "a  b"), (5, "a b"), (5, "a b"), (None, "a\tb"), (7, "é " * 50), (8, "x" * 200_000), (9, "12 34 !!"), (10, "中文 字")]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- line rules --------------------------------------------------------------------------


def judged(rows, limit=8):
    """rows of (doc_id, host, text) -> the report, by definition."""
    def normal(line):
        return re.sub("[ \t\n\v\f\r]+", " ", re.sub("[0-9]+", "0", re.sub("[A-Z]", lambda m: m[0].lower(), line))).strip(" ")

    texts = defaultdict(set)
    for _, host, text in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                texts[(host or "", normal(line))].add(text)
    out = []
    for doc, host, text in rows:
        text = text or ""
        words, lines = WORD.findall(text), text.split("\n")
        grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
        dups = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
        gone = sum(len(WORD.findall(x)) for x in lines if WORD.search(x) and len(texts[(host or "", normal(x))]) > limit)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        kept = not failed and 100 * (len(words) - gone) >= 50 * len(words)
        out.append((doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered), failed, kept, gone))
    return out


def made_documents(rng, count):
    footer = ["Read More at 12:30", "read  more at 7:45\r", "Copyright 2024 # all | rights", "é ü ß"]
    rows = []
    for doc in range(count):
        lines = [" ".join(rng.choice("alpha beta gamma delta x1 y2 $3 <b>".split()) + rng.choice(["", str(rng.randint(0, 99))]) for _ in range(rng.randint(0, 12)))
                 for _ in range(rng.randint(0, 8))]
        lines += rng.sample(footer, rng.randint(0, 3)) + ([lines[0]] if lines and rng.random() < 0.3 else [])
        rows.append((doc, rng.choice(["h", "h", "i", None]), "\n".join(lines)))
    return rows + rows[:5]


def reported(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("row_no", F.lit("mine"))
    return sorted(map(tuple, line_rules.report(docs, **options).collect()), key=repr)


@pytest.mark.parametrize("seed,limit", [(1, 8), (2, 3), (3, 0)])
def test_line_rules_equal_their_definition(spark, seed, limit):
    rows = made_documents(random.Random(seed), 120)
    got = reported(spark, rows, limit=limit)
    assert got == sorted(judged(rows, limit), key=repr)
    assert any(r[8] for r in got) and any(not r[6] and r[7] == (limit > 0) for r in got)


def test_line_rules_take_odd_rows(spark, table):
    got = line_rules.report(table(ODD)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(judged([(i, "src", t) for i, t in ODD]), key=repr)
    assert line_rules.report(table([])).count() == 0


def test_copies_do_not_condemn_their_original(spark):
    text = "\n".join(f"line {chr(97 + i)} has words enough to stay here" for i in range(10))
    near = [(100 + i, "h", text.replace("enough", f"enough{chr(97 + i)}", 1)) for i in range(3)]
    rows = [(i, "h", text) for i in range(30)] + near
    assert all(r[7] for r in reported(spark, rows))
    assert not any(r[7] for r in reported(spark, rows, limit=2))


def own(i):
    """A word of letters, as digits are all alike in normalised lines."""
    return "".join("abcdefghij"[int(x)] for x in str(i))


def test_cleaned_texts_lose_their_frequent_lines_only(stored, spark):
    rows = [(i, "h", f"Shared Footer {i}\n{own(i)} " + " ".join("w" + own(k) for k in range(30)) + "\n\nlast" + own(i)) for i in range(12)] + [(99, "h", "Shared footer 5"), (100, "i", "Shared footer 5")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("row_place", F.lit(7)))
    out = line_rules.cleaned(docs)
    assert out.columns == docs.columns and {r.row_place for r in out.collect()} == {7}
    texts = {r.doc_id: r.text for r in out.collect()}
    assert set(texts) == set(range(12)) and all(t == "\n".join(rows[i][2].split("\n")[1:]) for i, t in texts.items())


def test_line_rules_hot_host_and_line(spark):
    rows = [(i, "hot", "the same line everywhere\n" + " ".join(own(i) + own(k) for k in range(25))) for i in range(3000)]
    got = reported(spark, rows)
    assert len(got) == 3000 and all(r[7] and r[8] == 4 for r in got)


# --- hard negatives ------------------------------------------------------------------------


def mined(rows, every=100, want=5):
    """rows of (vec_id, label, vector) -> result rows, by definition."""
    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, (anchor, label, vector) in enumerate(rows):
        if anchor % every:
            continue
        scored = sorted(((-score(vector, v), j, lab == label, k) for k, (j, lab, v) in enumerate(rows) if k != i), key=lambda x: (x[0], x[1]))
        for s, positive, _, _ in [x for x in scored if x[2]][:want]:
            found = [(j, -n) for n, j, same, _ in scored if not same and 80 * -s <= 100 * -n <= 100 * -s][:want]
            out += [(anchor, positive, rank, j, -s, n) for rank, (j, n) in enumerate(found, 1)]
    return out


VECTORS = "vec_id long, label long, vector array<long>"


def run_mine(spark, rows, **options):
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(3), **options)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("seed,sizes", [(1, {}), (2, dict(block=7, pack=3, page=2)), (3, dict(block=1, pack=1, page=1)), (4, dict(block=50, pack=2, page=4))])
def test_hard_negatives_equal_brute_force(spark, seed, sizes):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-40, 60, (6, 8))
    rows = [(i, int(rng.integers(0, 4)), (centres[rng.integers(0, 6)] + rng.integers(-9, 9, 8)).tolist()) for i in range(300)]
    expected = sorted(mined(rows, every=20))
    assert run_mine(spark, rows, every=20, **sizes) == expected and len(expected) > 50


def test_hard_negatives_with_ties_repeats_and_ragged_vectors(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 2), [rng.randint(-1, 2) for _ in range(rng.randint(0, 4))]) for i in range(120)]
    rows += [(i, lab, v) for i, lab, v in rows[:30]] + [(-100, 1, [1, 1]), (-50, 0, [1, 1])]
    assert run_mine(spark, rows, every=10, block=8, pack=4, page=2) == sorted(mined(rows, every=10))


def test_hard_negatives_of_large_numbers_and_few_rows(spark):
    big = 1 << 29
    rows = [(0, 1, [big, 1 - big]), (1, 1, [big, 3]), (2, 0, [big - 9, 1]), (3, 0, [big - 5, 2 - big]), (100, 2, [1, 1])]
    assert run_mine(spark, rows) == sorted(mined(rows)) != []
    assert run_mine(spark, []) == [] and run_mine(spark, [(100, 1, [1])]) == [] and run_mine(spark, [(100, 1, [1]), (200, 1, [2])]) == []


def test_quantised_leaves_out_what_takes_no_part(spark):
    rows = [(1, 1, [0.5, -0.001]), (None, 1, [0.5]), (2, None, [0.5]), (3, 1, None), (4, 1, [None]), (5, 1, [float("nan")]), (6, 1, [float("inf")]), (7, 1, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("vector", F.lit("x")).withColumn("block", F.lit(1))
    assert sorted(map(tuple, hard_negatives.quantised(df).collect())) == [(1, 1, [128, -1]), (7, 1, [])]


def test_blocks_out_of_reach_are_not_read(spark):
    """Clusters far apart: the bounds leave an anchor only blocks of its own side."""
    rng = np.random.default_rng(7)
    centres = np.array([[900, 0, 0, 0], [0, 900, 0, 0], [0, 0, 900, 0], [0, 0, 0, 900]])
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 4] + rng.integers(-20, 20, 4)).tolist()) for i in range(800)]
    stored = hard_negatives.Candidates(spark.createDataFrame(rows, VECTORS), 50, block=20)
    asked = stored.anchors.withColumns({"lows": F.array(F.lit(400_000).cast("long")), "highs": F.array(F.lit(hard_negatives.FAR))})
    requests = stored.requests(asked, False, None)
    read = requests.select(F.expr("sum(length(nos) / 8)")).first()[0]
    assert 0 < read < 0.4 * stored.anchors.count() * stored.blocks.count()


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(1)
    a, rows = rng.integers(-50, 50, (20, 6)), rng.integers(-50, 50, (40, 6))
    low, high = rows.min(axis=0, keepdims=True), rows.max(axis=0, keepdims=True)
    upper = hard_negatives.products(np.maximum(a, 0), high) + hard_negatives.products(np.minimum(a, 0), low)
    scores = hard_negatives.products(a, rows)
    assert (scores <= upper).all() and (scores == [[sum(map(math.prod, zip(x, y))) for y in rows.tolist()] for x in a.tolist()]).all()


# --- tokenizer alignment ---------------------------------------------------------------------


def test_group_ends_are_the_common_ends():
    rng = np.random.default_rng(2)
    for trial in range(300):
        n = int(rng.integers(1, 400))
        cuts = [np.unique(np.append(rng.choice(n, rng.integers(0, n) if trial % 3 else max(0, n - 3), replace=False) + 1, n)).astype(np.uint32) for _ in range(2)]
        last_a, last_b = tokenizer_alignment.group_ends(*cuts)
        common = np.intersect1d(*cuts)
        assert (cuts[0][last_a] == common).all() and (cuts[1][last_b] == common).all() and len(last_a) == len(common)


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = tokenizer_alignment.default_paths()
    slow = Tokenizer.from_file(a)
    slow.encode_special_tokens = True
    return slow, sentencepiece.SentencePieceProcessor(model_file=b)


TEXTS = [None, "", " ", "a", "Hello world", "two  spaces   three", "\n\nlines\r\nand\ttabs \n", "don't <|endoftext|> </s> <unk> <0x0A>", "naïve façade – “quotes”",
         "日本語の文章です。", "emoji 😀👍🏽 mix", "holds ▁ the mark", "x" * 3000, "word " * 700, "12345 67,890.5", " nbsp em", "tabs\t\tand\rreturn);\r\n", "\x00nul", "Ǆ ǅ ⅷ ٣"]


def aligned(both, texts):
    """The report by definition: whole texts through both libraries, ends compared as sets."""
    pair = tokenizer_alignment.pair(None, None)
    rows, pairs = [], Counter()
    for text in texts:
        a, b = ([], []) if not text else (both[0].encode(" " + text, add_special_tokens=False).ids, both[1].encode(text))
        raw = [b"".join(table[i] for i in ids) for table, ids in ((pair.raw_a, a), (pair.raw_b, b))]
        if not text or raw[0] != (" " + text).encode() or raw[1] != raw[0]:
            rows.append(None)
            continue
        ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((pair.raw_a, a), (pair.raw_b, b))]
        groups, links = [], []
        for end in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0].index(end), ends[1].index(end)
            links.append((a[i], b[j]))
            groups.append((i, j))
        cut = [(a[i0 + 1:i1 + 1], b[j0 + 1:j1 + 1]) for (i0, j0), (i1, j1) in zip([(-1, -1), *groups], groups)]
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in cut)
        pairs.update(links)
        rows.append((len(a), len(b), len(cut), links, hashlib.sha256(line.encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(pairs[x] == best[x[1]] for x in r[3]), sum(pairs[x] for x in r[3]), r[4]) for r in rows]


def test_alignment_equals_its_definition(spark, table, both):
    texts = TEXTS + [t for t in TEXTS if t][:6]
    docs = table(list(enumerate(texts)), spread=True)
    got = sorted(map(tuple, tokenizer_alignment.report(docs).collect()))
    assert got == [(i, *row) for i, row in enumerate(aligned(both, texts))]
    assert got[11] == (11, 0, 0, 0, 0, 0, 0, "") and sum(r[1] > 0 for r in got) >= 20


def test_alignment_of_the_documents(spark, both):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = docs.collect()
    got = sorted(map(tuple, QUERIES["op13_tokenizer_alignment"](spark, "/root/testdata/sf0.001").collect()))
    assert got == [(r.doc_id, *x) for r, x in zip(rows, aligned(both, [r.text for r in rows]))]


def test_alignment_takes_odd_rows(spark, table):
    got = tokenizer_alignment.report(table(ODD)).collect()
    assert len(got) == len(ODD) and sum(r.n_a == 0 for r in got) == 2
    assert tokenizer_alignment.report(table([])).count() == 0


def test_aligned_tokens_give_the_groups(spark, table):
    row = tokenizer_alignment.align(table([(1, "Hello wonderful alignment"), (2, None)])).orderBy("doc_id").collect()
    pair = tokenizer_alignment.pair(None, None)
    assert row[1].a_ids == [] and len(row[0].a_last) == len(row[0].b_last)
    begin = (0, 0)
    for i, j in zip(row[0].a_last, row[0].b_last):
        assert b"".join(pair.raw_a[x] for x in row[0].a_ids[begin[0]:i + 1]) == b"".join(pair.raw_b[x] for x in row[0].b_ids[begin[1]:j + 1])
        begin = (i + 1, j + 1)
    assert begin == (len(row[0].a_ids), len(row[0].b_ids))


def test_linked_pairs_are_bounded_by_the_vocabularies(spark, table):
    pair = tokenizer_alignment.pair(None, None)
    grouped = tokenizer_alignment.rows_of(table([(i, t) for i, t in enumerate(TEXTS)])).mapInArrow(
        tokenizer_alignment.aligner(None, None, True), tokenizer_alignment.GROUPED)
    found = tokenizer_alignment.pair_counts(grouped, len(pair.raw_b)).collect()
    assert all(pair.raw_a[r.a_id].endswith(pair.raw_b[r.b_id]) or pair.raw_b[r.b_id].endswith(pair.raw_a[r.a_id]) for r in found)
    assert len(found) <= pair.possible_pairs() < 400_000
