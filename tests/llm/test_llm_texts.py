"""Classifiers, packing, fingerprints and sentence pieces."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from gridspark.llm import fingerprints, language, packing, quality, sentence_pieces, toxicity
from gridspark.llm.common import held_out

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a  b"), (5, "a b"), (5, "a b"), (None, "a\tb"), (7, "é " * 50), (8, "x" * 200_000), (9, "12 34 !!"), (10, "中文 字")]


@pytest.fixture(scope="module")
def small(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels")]


def shares(scored, labels, label):
    rows = scored.join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_toxicity_on_held_out_rows_and_odd_texts(table, small):
    docs, labels = small
    model = toxicity.fit(docs, labels)
    assert shares(toxicity.scored(docs, model), labels, "toxic") > 0.93
    odd = toxicity.scored(table(ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.scored(table([]), model).count() == 0
    kept = toxicity.keep_harmless(table(ODD), model)
    assert kept.columns == table(ODD).columns and kept.count() == len(ODD)


def test_toxicity_learns_nothing_from_the_held_out_fold(spark, small):
    from pyspark.sql import functions as F

    docs, labels = small
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxicity.scored(docs, toxicity.fit(docs, x)).select("doc_id", "score").collect() for x in (labels, flipped))
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))


def test_toxicity_without_labels(small, table):
    docs, labels = small
    model = toxicity.fit(docs, labels.filter("toxic = 7"))
    assert {r.score for r in toxicity.scored(table(ODD), model).collect()} == {0.0}


def test_index_finds_the_exact_neighbours():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        place = np.sort(rng.choice(60, rng.integers(0, 8), replace=False))
        value = rng.random(len(place)) + 0.1
        vectors.append((place, value / np.sqrt((value * value).sum()) if len(place) else value))
    flat = toxicity.Sparse(np.concatenate([[0], np.cumsum([len(p) for p, _ in vectors])]), *(np.concatenate(x) for x in zip(*vectors)))
    index = toxicity.Index(flat, 60)
    full = np.zeros((500, 60))
    for i, (p, v) in enumerate(vectors):
        full[i, p] = v
    asked = np.arange(0, 500, 7)
    near, found = index.nearest(flat.take(asked), without=asked)
    for i, got, weight in zip(asked, near, found):
        cosine = np.round(full @ full[i], 9)
        best = [j for j in np.lexsort((np.arange(500), -cosine)) if cosine[j] > 0 and j != i][:toxicity.K]
        assert got[got >= 0].tolist() == best and np.allclose(weight[got >= 0], cosine[best])


def test_quality_on_held_out_rows_and_odd_texts(table, small):
    docs, labels = small
    model = quality.fit(docs, labels)
    assert shares(quality.scored(docs, model), labels, "quality") > 0.9
    odd = quality.scored(table(ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality.scored(table([]), model).count() == 0
    blind = quality.fit(docs, labels.filter("quality = 7"))
    assert {r.score for r in quality.scored(table(ODD), blind).collect()} == {0.5}


def test_quality_scales_by_all_documents(small, monkeypatch):
    import pyarrow as pa
    from gridspark.llm.common import blocks

    monkeypatch.setattr(quality, "UNLABELLED", 50)
    docs, labels = small
    every = np.concatenate([quality.vectors(b) for b in blocks(pa.array([r.text or "" for r in docs.select("text").collect()]))])
    model = quality.fit(docs, labels)
    assert np.allclose(model.centre, every.mean(axis=0), atol=2e-3) and np.allclose(model.spread, every.std(axis=0) + 0.05, atol=2e-3)


def test_prior_and_threshold_of_separable_scores():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(3, 1, 4000), rng.normal(-3, 1, 1000)
    mixed = np.concatenate([rng.normal(3, 1, 4000), bad])
    assert abs(quality.estimate_prior(good, mixed) - 0.8) < 0.05
    assert -1.5 < quality.threshold(good, mixed) < 1.5


def test_language_on_held_out_rows_and_odd_texts(table, small):
    docs, _ = small
    model = language.learn(docs)
    rows = language.predicted(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    got = {r.doc_id: r.lang_pred for r in language.predicted(table(ODD), model).collect()}
    assert {got[i] for i in (1, 2, 3, 9)} == {"und"} and got[10] != "und"
    assert language.predicted(table([]), model).count() == 0
    nothing = language.learn(docs.filter("lang = 'xx'"))
    assert {r.lang_pred for r in language.predicted(table(ODD), nothing).collect()} == {"und"}


def test_more_languages_than_a_word_has_bits(spark):
    rng = random.Random(8)
    rows = []
    for k in range(70):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(30)]
        # Later languages are rarer.
        rows += [(1000 * k + i, " ".join(rng.choice(words) for _ in range(60)), f"l{k:02}") for i in range(16 if k < 64 else 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predicted(docs, language.learn(docs)).join(docs, "doc_id").collect()
    assert len(got) == len(rows) and all(r.lang_pred == r.lang for r in got)
    assert len({r.lang for r in got if r.held_out}) > 60 and any(r.held_out and r.lang > "l63" for r in got)


def test_filter_has_no_false_negatives_and_corrects_false_positives():
    from gridspark.llm.common import blocks, mix
    import pyarrow as pa

    block = next(blocks(pa.array(["the quick brown fox", "el zorro marrón"])))
    rows, hashes = language.grams(block)
    noise = mix(np.arange(300_000, dtype=np.uint64))
    model = language.Filter(["one", "two"], [hashes[rows == 0], np.concatenate([hashes[rows == 1], noise])])
    counts, n = model.counts(block)
    assert counts[0, 0] == n[0] and counts[1, 1] == n[1] and model.false[1] > 0.05
    assert counts[0, 1] < 0.5 * n[0]


def test_packing_is_the_tokenizer_ids_cut_into_full_sequences(table, stored):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    rows = ODD + [(100 + i, "".join(rng.choice("ab C.\n \té中'sll12<|endoftext|>") for _ in range(rng.randint(0, 900)))) for i in range(40)]
    rows += [(200, "x <|endoftext|> y"), (201, "a  b\x85 c  \n\n d\x1ce")]
    slow = Tokenizer.from_file(packing.default_path())
    got = packing.pack(stored(table(rows)), length=64).collect()
    expected = sorted((i is None, i or 0, slow.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows)
    docs, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        places[r.sequence_id].append((r.offset, r.length))
        docs[r.sequence_id * 64 + r.offset - r.start].append(r)
    whole = []
    for pieces in docs.values():
        pieces.sort(key=lambda r: r.start)
        ids = [x for r in pieces for x in r.ids]
        assert len(ids) == pieces[0].doc_tokens
        whole.append((pieces[0].doc_id is None, pieces[0].doc_id or 0, ids))
    assert sorted(whole) == expected
    fill = [sum(n for _, n in sorted(x)) for _, x in sorted(places.items())]
    assert set(fill[:-1]) == {64} and sorted(places) == list(range(len(places)))
    assert packing.pack(stored(table([]))).count() == 0


def test_hilbert_curve_visits_every_cell_once_and_steps_to_neighbours():
    n, bits = 3, 2
    cells = np.array(list(np.ndindex(*[1 << bits] * n)))
    keys = packing.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_fingerprints_agree_with_the_texts(table):
    rng = random.Random(4)
    rows = {1: "", 2: "", 3: "short", 4: "é" * 70, **{i: "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 400))) for i in range(5, 60)}}
    rows[60] = rows[59]
    got = {r.doc_id: r for r in fingerprints.compared(table(list(rows.items()), spread=True)).collect()}
    ids = sorted(rows, reverse=True)
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, half = rows[i], len(rows[i]) // 2
        edited = text[:len(text) - half] + rows[following][:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (text == edited)
        assert (got[i].near_next == 1) == (text == rows[following])
        if len(text) > 64 and len(rows[following]) >= half:
            assert got[i].near_edited >= 0.4
    assert fingerprints.compared(table([])).count() == 0
    odd = fingerprints.compared(table(ODD)).collect()
    assert len(odd) == len(ODD) and odd[0].near_next is not None
    assert fingerprints.compared(table([(1, "alone")])).first().near_next == 1


def test_spans_and_extensions_of_prefix_hashes():
    rng = random.Random(5)
    a, b = ("".join(rng.choice("ab") for _ in range(80)) for _ in range(2))
    one, other = (fingerprints.Prefixes(fingerprints.points(x)) for x in (a, b))
    for _ in range(200):
        i, j = rng.randrange(80), rng.randrange(80)
        n = 0
        while i + n < 80 and j + n < 80 and a[i + n] == b[j + n]:
            n += 1
        assert one.extension(i, other, j) == n
        assert one.equal(i, other, j, n)


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.load(sentence_pieces.default_path())


def test_pieces_equal_the_library_and_come_back(model, table, small):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_path())
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab c\n\té中\U0001d4b3  <s>the in") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += [r.text for r in small[0].limit(40).collect()] + ["", " ", "\x00", "word" * 60, "中文字" * 40]
    for text in texts:
        ids = model.encode(text).tolist()
        assert ids == library.encode(text)
        assert model.decode(ids) == text
        marked = "▁" + text.replace(" ", "▁")
        if text:
            assert model.ids_of(model.stream(marked[k:k + 3] for k in range(0, len(marked), 3))) == ids
    got = sentence_pieces.checked(table(ODD)).collect()
    assert len(got) == len(ODD) and all(r.round_trip for r in got)
    assert sentence_pieces.checked(table([])).count() == 0
    back = {r.doc_id: r.text for r in sentence_pieces.decode(sentence_pieces.encode(table([(1, "a b"), (2, None)]))).collect()}
    assert back == {1: "a b", 2: ""}


def test_streamed_unigram_paths_have_the_largest_score():
    rng = random.Random(7)
    pieces = [("<unk>", 0.0)] + [(x, -rng.random() * 5) for x in ("a", "b", "c", "ab", "bc", "abc", "ca", "aa", "bca", "cab")]
    model = sentence_pieces.Pieces(pieces, {}, 0, merges=False)

    def best(text):
        ways = [(0.0, [])] + [(-1e18, [])] * len(text)
        for end in range(1, len(text) + 1):
            for begin in range(max(0, end - 3), end):
                piece = text[begin:end]
                if piece in model.ids or end - begin == 1:
                    score = ways[begin][0] + model.scores.get(piece, model.penalty)
                    if score > ways[end][0]:
                        ways[end] = (score, ways[begin][1] + [piece])
        return ways[-1]

    for _ in range(200):
        text = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 60)))
        got = list(model.stream([text[:7], text[7:]] if len(text) > 7 else [text]))
        score = sum(model.scores.get(p, model.penalty) for p in got)
        assert "".join(got) == text and abs(score - best(text)[0]) < 1e-9


def test_stream_forgets_what_is_final(model):
    held = []

    def chunks():
        for _ in range(300):
            yield "▁the▁thing"
            held.append(len(out))

    out = []
    for piece in model.stream(chunks()):
        out.append(piece)
    # Pieces come out while the text is still arriving.
    assert held[-1] > 0.8 * len(out)
