"""Encoding (3), toxicity (4), decontamination (5), and line rules (6)."""

import hashlib
import random
import resource
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from waymark.llm import bpe_lexicon, line_rules, seed_align, toxic_cnn
from waymark.llm.common import lower_words, word_counts, words

PATH = bpe_lexicon.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


# -- 3 -----------------------------------------------------------------------


def test_encoding_like_the_library(library, documents, texts):
    rows = bpe_lexicon.encode(documents).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids, decoded = encoded(library, texts[row["doc_id"]])
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["decoded"] == decoded
    digest = bpe_lexicon.digests(bpe_lexicon.encode(documents)).filter("doc_id = 3").head()
    ids, decoded = encoded(library, texts[3])
    assert digest["n_tokens"] == len(ids)
    assert digest["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert digest["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_encoding_odd_rows(library, odd_docs, no_docs):
    given = {row["doc_id"]: row["text"] for row in odd_docs.collect() if row["doc_id"]}
    rows = bpe_lexicon.encode(odd_docs).collect()
    assert len(rows) == 15
    for row in rows:
        if row["doc_id"]:
            ids, decoded = encoded(library, given[row["doc_id"]] or "")
            assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["decoded"] == decoded
    assert bpe_lexicon.encode(no_docs).count() == 0


def test_encoding_noise(library):
    rng = random.Random(3)
    pieces = [
        " ", "  ", "\n", "\t", "a", "B", "é", "ß", "漢", "字", "١", "²", "'s", "'S", "<|endoftext|>",
        "<|endof", "\U0001f600", "‍", "0", "!", "...", "\0", "the", " theme", "\u0085", "　",
    ]
    noise = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    vocabulary = bpe_lexicon.load_vocabulary(PATH)
    known = [b"the", b" theme", b"the theme", "é".encode(), b"th", b"a"]
    packed = bpe_lexicon.Merger(vocabulary).merge(known)
    block = bpe_lexicon.compile_lexicon(
        {word: np.frombuffer(ids, "<u4").tolist() for word, ids in zip(known, packed)}
    )
    encoder = bpe_lexicon.Encoder(bpe_lexicon.Lexicon(block), vocabulary)
    for text, ids in zip(noise, encoder.encode(noise)):
        assert np.frombuffer(ids, "<u4").tolist() == encoded(library, text)[0], text


def test_transducer():
    entries = {b"tap": [1], b"taps": [2, 3], b"top": [4], b"tops": [5], b"a": [6, 7, 8]}
    lexicon = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(entries))
    found = lexicon.numbers([*entries, b"", b"ta", b"tapsx", b"x"])
    assert [np.frombuffer(lexicon.packed(n), "<u4").tolist() for n in found[:5]] == [
        *entries.values()
    ]
    assert found[5:].tolist() == [-1] * 4
    assert len(lexicon.final) < 8  # suffixes are shared: not one state per letter
    empty = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({}))
    assert empty.numbers([b"a"]).tolist() == [-1]


def test_merging_alone_and_together():
    vocabulary = bpe_lexicon.load_vocabulary(PATH)
    rng = random.Random(5)
    some = [bytes(rng.choice(b"theionrsab ") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    for word, packed in zip(some, bpe_lexicon.Merger(vocabulary).merge(some)):
        assert np.frombuffer(packed, "<u4").tolist() == bpe_lexicon.merge_word(word, vocabulary)


def test_words_are_counted_as_texts_and_pieces_gathered(spark, library, monkeypatch):
    texts = ["é 漢 a a", "a é<|endoftext|>a", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = word_counts(rows, str.split).collect()
    assert {(bytes(r["word"]).decode(), r["count"]) for r in counted} == {
        ("é", 1), ("漢", 1), ("a", 3), ("é<|endoftext|>a", 1),
    }
    vocabulary = bpe_lexicon.load_vocabulary(PATH)
    encoder = bpe_lexicon.Encoder(
        bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({})), vocabulary
    )
    monkeypatch.setattr(bpe_lexicon, "SLICE_IDS", 2)  # a letter's bytes fall apart
    for text, packed in zip(texts, encoder.encode(texts)):
        ids, _ = encoded(library, text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert encoder.decode(packed) == library.decode(ids, skip_special_tokens=False) == text
    with pytest.raises((KeyError, IndexError)):
        encoder.decode(np.array([4_000_000], "<u4").tobytes())


# -- 4 -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.1"
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels")]


def test_words_are_stored_and_their_buckets_remembered(spark, monkeypatch):
    monkeypatch.setattr(toxic_cnn, "REMEMBERED", 3)
    text = "The cat's on-going tale, é 漢字 the international internationals"
    tokens = b"the cat s on going tale \xc3\xa9 \xe6\xbc\xa2\xe5\xad\x97 the international internationals"
    for _ in range(2):
        kinds = [[t, t[:4] + b"-", t[:5] + b"-", t[:7] + b"-"] for t in tokens.split()]
        wanted = [[zlib.crc32(kind) % toxic_cnn.BUCKETS for kind in row] for row in kinds]
        assert toxic_cnn.buckets(text).tolist() == wanted
    assert toxic_cnn.buckets(None).shape == toxic_cnn.buckets(" ,").shape == (0, 4)
    docs = spark.createDataFrame([(i, text * i or None, "en") for i in range(9)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    for row in toxic_cnn.labelled_rows(docs, labels).collect():
        assert zlib.decompress(row["words"]).split() == toxic_cnn.plain_words(text * row["doc_id"])


def test_words_of_many_texts_are_hashed_together(monkeypatch):
    calls, crc32 = [], zlib.crc32
    monkeypatch.setattr(toxic_cnn.zlib, "crc32", lambda *given: calls.append(1) or crc32(*given))
    texts = ["", "a", None, " \t\n\v\f\r.,;", "Four FIVES sevenly é 漢字 a\x1cb\x00c\u0085", "x" * 24, "y" * 25 + " z", "w" * 5000]
    texts += [" ".join(f"{i}word{i * j}" for j in range(i)) for i in range(60)] + [""]
    plain = [toxic_cnn.plain_text(text or "") for text in texts]
    for at_once in (5, toxic_cnn.REMEMBERED):
        monkeypatch.setattr(toxic_cnn, "REMEMBERED", at_once)
        calls.clear()
        found, counts = toxic_cnn._hashed(plain)
        assert len(calls) == 2  # the words over 24 bytes
        tokens = [toxic_cnn.plain_words(text or "") for text in texts]
        assert counts.tolist() == [len(own) for own in tokens]
        kinds = [[t, t[:4] + b"-", t[:5] + b"-", t[:7] + b"-"] for own in tokens for t in own]
        assert found.T.tolist() == [[crc32(kind) % toxic_cnn.BUCKETS for kind in row] for row in kinds]
    monkeypatch.setattr(toxic_cnn, "SLICE_WORDS", 100)
    slices = list(toxic_cnn._slices(iter(plain)))
    assert len(slices) > 10 and all(own.sum() <= 100 for _, own in slices)
    assert np.array_equal(np.hstack([ids for ids, _ in slices]), found)
    assert np.concatenate([own for _, own in slices]).tolist() == counts.tolist()
    empty = toxic_cnn._hashed([])
    assert empty[0].shape == (4, 0) and len(empty[1]) == 0 and not list(toxic_cnn._slices([]))


def test_strongest_answers_of_texts_end_to_end():
    """Ties, few different answers and short texts, against one text at a time."""
    rng = np.random.default_rng(8)
    sizes = np.array([2, 2, 3, 40, 5, 2, 17])
    part = rng.integers(-3, 4, (toxic_cnn.FILTERS, sizes.sum())).astype(np.float32)
    part[:, :2] = 0  # a text without words
    wanted = []
    for own in np.split(part, np.cumsum(sizes[:-1]), axis=1):
        places = []
        for _ in range(toxic_cnn.TOP):
            places.append(own.argmax(axis=1))
            own = np.where(own >= own.max(axis=1)[:, None], np.float32(toxic_cnn.NEVER), own)
        wanted.append(places)
    wanted += (np.cumsum(sizes) - sizes)[:, None, None]
    before = part.copy()
    assert np.array_equal(toxic_cnn._strongest(part, sizes), wanted)
    assert np.array_equal(part, before)  # the answers are read again


def test_pulls_are_summed_as_one_by_one():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 40, 3000).astype(np.int32) ** 2 % 50
    pulls = rng.normal(size=(3000, toxic_cnn.DIMENSIONS))
    values = rng.normal(size=(50, toxic_cnn.DIMENSIONS)).astype(np.float32)
    sums = np.full_like(values, 1e-6)
    slope = np.zeros_like(values)
    np.add.at(slope, rows, pulls)
    slope[0] = 0
    wanted_sums = sums + slope**2
    wanted = values - np.float32(0.1) * slope / np.sqrt(wanted_sums)
    moved = toxic_cnn._move_rows(values, sums, rows, pulls, 0.1)
    assert moved.tolist() == sorted(set(rows.tolist()) - {0})
    assert np.array_equal(sums, wanted_sums) and np.allclose(values, wanted, atol=1e-6)
    assert len(toxic_cnn._move_rows(values, sums, rows[:9] * 0, pulls[:9], 0.1)) == 0
    assert np.array_equal(sums, wanted_sums)


def test_toxicity_on_held_out_rows(larger):
    documents, labels = larger
    found = toxic_cnn.classify(documents, labels)
    frame = found.join(labels, "doc_id").filter("held_out").toPandas()
    assert (frame["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in frame.doc_id]).all()
    assert ((frame["score"] >= 0.5).astype(int) == frame["predicted"]).all()
    assert (frame["predicted"] == frame["toxic"]).mean() > 0.97
    ranks = frame["score"].rank()
    toxic = frame["toxic"] == 1
    area = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (
        toxic.sum() * (~toxic).sum()
    )
    assert area > 0.97
    assert (frame["flagged"] == (frame["toxic"] == 1)).mean() > 0.97


def test_toxicity_odd_rows(spark, odd_docs, no_docs, larger):
    labels = larger[1]
    few = spark.createDataFrame([(7, 1), (4, 0), (9, 0), (11, 0), (12, 1)], "doc_id long, toxic int")
    for given in (few, labels.limit(0), few.filter("toxic = 1")):
        rows = toxic_cnn.classify(odd_docs, given).collect()
        assert len(rows) == 15 and all(0 <= row["score"] <= 1 for row in rows)
        assert toxic_cnn.classify(no_docs, given).count() == 0
        kept = toxic_cnn.without_toxic(odd_docs, given)
        assert kept.columns == odd_docs.columns and kept.count() <= 15
    assert toxic_cnn.without_toxic(odd_docs, labels.limit(0)).count() == 15


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """More rows of either label than the sample once had, over several parts;
    how Spark deals the rows out changes no weight."""
    rows = [(i, f"{'vile' if i % 2 else 'kind'} word{i % 50} rare{i // 100}x") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    learned = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    stored = toxic_cnn.labelled_rows(docs, labels)
    assert sorted(row[0] for row in stored.select("doc_id").collect()) == learned
    rare = {int(toxic_cnn.buckets(f"rare{i}x")[0, 0]) for i in range(80)}
    known = toxic_cnn.known_buckets(stored.filter("not held"))
    assert rare <= set(known.tolist())
    monkeypatch.setattr(toxic_cnn, "PART_ROWS", 1000)
    monkeypatch.setattr(toxic_cnn, "EPOCHS", 1)
    first = toxic_cnn.fit(docs, labels)
    again = toxic_cnn.fit(docs.repartition(11), labels.repartition(5))
    for one, other in zip(
        toxic_cnn.State(first.network, []).weights(), toxic_cnn.State(again.network, []).weights()
    ):
        assert np.array_equal(one, other)
    scores = first.scores(["vile word3 rare7x", "kind word3 rare7x"])
    assert first.centre == again.centre and scores[0] > 0.5 > scores[1]


# -- 5 -----------------------------------------------------------------------


def plain_alignment(item, text):
    table = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            table[i][j] = max(
                0,
                table[i - 1][j - 1] + (2 if a == b else -1),
                table[i - 1][j] - 1,
                table[i][j - 1] - 1,
            )
    return max(map(max, table))


def test_alignment():
    rng = random.Random(6)
    for _ in range(200):
        item = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 15))])
        text = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 30))])
        score, start, end = seed_align.align(item, text)
        assert score == plain_alignment(item, text) == plain_alignment(item, text[start:end])


def test_passages(spark, documents, texts):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {row["item_id"]: row["text"] for row in benchmark.collect()}
    rng = random.Random(8)
    rows = [(10_000 + i, text) for i, text in texts.items()]
    expected = set()
    for number, (item, text) in enumerate(sorted(items.items())):
        found = text.split()
        if number % 3 == 1:  # every eighth word another
            found = [f"other{i}" if i % 8 == 5 else word for i, word in enumerate(found)]
        elif number % 3 == 2:  # words left out and put in
            found = [w for i, w in enumerate(found) if i % 10 != 4] + ["added"]
        host = [rng.choice(["some", "other", "host", "words"]) for _ in range(60)]
        rows.append((number, " ".join(host[:30] + found + host[30:])))
        expected.add((number, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in seed_align.find_passages(docs, benchmark).collect()}
    planted = {pair for pair in found if pair[0] < 10_000}
    assert len(planted & expected) >= 0.95 * len(expected)
    # In the given documents: items that stand there word for word, and no item far from it.
    exact = {
        (10_000 + i, item)
        for i, text in texts.items()
        for item, passage in items.items()
        if " ".join(passage.lower().split()) in " ".join(text.lower().split())
    }
    assert exact <= found
    kept = {row["doc_id"] for row in seed_align.without_passages(docs, benchmark).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in found}


def test_a_long_item_in_a_long_document():
    """20,000 words each: two rows of the alignment at a time."""
    rng = random.Random(12)
    item = [f"w{rng.randint(0, 9000)}" for _ in range(20_000)]
    copy = [word if rng.random() < 0.9 else "other" for word in item]
    index = seed_align.index_items([" ".join(item), "three short words"])
    documents = np.ones(len(index.grams), np.int64)
    finder = seed_align.Finder(index, seed_align.rare_seeds(index, documents))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    [hit] = finder.find(" ".join(copy))
    assert hit["item"] == 0 and hit["similarity"] > 0.8 and hit["end_word"] > 19_900
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000  # KB


def test_many_copies_in_one_document():
    item = [f"w{i}" for i in range(50)]
    index = seed_align.index_items([" ".join(item)])
    documents = np.ones(len(index.grams), np.int64)
    finder = seed_align.Finder(index, seed_align.rare_seeds(index, documents))
    begun = time.time()
    [hit] = finder.find(" ".join(item * 400))
    assert hit["passages"] == 400 and hit["similarity"] == 1 and time.time() - begun < 20


@pytest.mark.parametrize("exact", [False, True])
def test_edited_copies_against_brute_force(exact):
    """Every pair of enough similarity is found, however the copy was edited."""
    rng = random.Random(15)
    common = [f"c{i}" for i in range(40)]

    def item(number, size):
        return [
            rng.choice(common) if rng.random() < 0.4 else f"w{number}x{i}" for i in range(size)
        ]

    items = [item(number, size) for number, size in enumerate((3, 5, 8, 15, 27, 40, 40, 59))]
    docs = []
    for number, found in enumerate(items):
        host = [rng.choice(common) for _ in range(120)]
        edits = [
            [f"other{i}" if i % every == every - 1 else word for i, word in enumerate(found)]
            for every in (3, 4, 5)
        ]
        edits += [found[: len(found) // 2 + 1], [w for pair in zip(found, found[::-1]) for w in pair]]
        edits += [[part for word in found for part in (word, "in")], [w for w in found if rng.random() < 0.7]]
        edits += [found + ["between"] + found] + [found] * exact
        docs += [host[:60] + edit + host[60:] for edit in edits]
    texts = [" ".join(doc) for doc in docs]
    index = seed_align.index_items([" ".join(found) for found in items])
    documents = np.zeros(len(index.grams), np.int64)
    for text in texts:
        documents[np.unique(index.grams_in(index.numbers(text))[1])] += 1
    finder = seed_align.Finder(index, seed_align.rare_seeds(index, documents))
    reached = 0
    for text in texts:
        numbers = index.numbers(text)
        expected = {}
        for number, found in enumerate(index.words):
            best = seed_align.align(found, numbers)[0] / (seed_align.MATCH * len(found))
            if best >= seed_align.SIMILARITY:
                expected[number] = best
        found = finder.find(text)
        assert {hit["item"]: hit["similarity"] for hit in found} == expected
        assert all(hit["passages"] >= 1 for hit in found)
        reached += len(expected)
    assert reached > 30


def test_passages_in_capitals(spark):
    passage = "ñandú ÉTÉ straße öl ação niño über œuvre čaj łódź ёлка щука Straße größer"
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = [(1, passage.upper()), (2, passage.lower()), (3, f"before {passage.upper()} after")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = seed_align.find_passages(docs, benchmark).collect()
    assert {(row["doc_id"], row["similarity"]) for row in rows} == {(1, 1.0), (2, 1.0), (3, 1.0)}
    assert seed_align.without_passages(docs, benchmark).count() == 0


def test_passages_in_blocks(spark, documents, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = set(map(tuple, seed_align.find_passages(documents, benchmark).collect()))
    monkeypatch.setattr(seed_align.blocks, "__defaults__", (500,))
    cut = set(map(tuple, seed_align.find_passages(documents, benchmark).collect()))
    assert whole == cut and whole


def test_passages_odd_rows(spark, odd_docs, no_docs):
    items = [(1, None), (2, ""), (3, "one two"), (4, "same text here twice and more words"), (4, "same text here twice and more words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = seed_align.find_passages(odd_docs, benchmark).collect()
    assert {(row["doc_id"], row["item_id"]) for row in rows} == {(11, 4), (12, 4)}
    assert all(row["similarity"] == 1 for row in rows)
    assert seed_align.find_passages(odd_docs, benchmark.limit(0)).count() == 0
    assert seed_align.find_passages(no_docs, benchmark).count() == 0
    kept = seed_align.without_passages(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == 13
    assert kept.filter("text is null").count() == 2


# -- 6 -----------------------------------------------------------------------


def plain_measures(text):
    tokens = words(text)
    windows = Counter(zip(tokens, tokens[1:], tokens[2:]))
    covered = set()
    for i, window in enumerate(zip(tokens, tokens[1:], tokens[2:])):
        if windows[window] > 1:
            covered |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    chars = sum(len(word.decode()) for word in tokens)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(tokens) < 50 or 100 * len(covered) > 50 * len(tokens)
    return len(tokens), chars, symbols, again, len(covered), failed


def test_line_rules(documents, texts, odd_docs, no_docs):
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    for row in line_rules.apply_rules(documents).collect():
        assert tuple(row[c] for c in columns) == plain_measures(texts[row["doc_id"]])
        assert not (row["kept"] and row["base_failed"])
    given = {row["doc_id"]: row["text"] for row in odd_docs.collect() if row["doc_id"]}
    rows = line_rules.apply_rules(odd_docs).collect()
    assert len(rows) == 15
    for row in rows:
        if row["doc_id"]:
            assert tuple(row[c] for c in columns) == plain_measures(given[row["doc_id"]] or "")
    assert line_rules.apply_rules(no_docs).count() == 0


def test_repeated_words_in_noise():
    rng = random.Random(7)
    for _ in range(500):
        text = " ".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        assert line_rules.repeated_words(words(text)) == plain_measures(text)[4]


def test_lines_go_and_documents_that_lose_too_much():
    body = "\n".join(" ".join(f"word{i}{j}" for j in range(9)) + "." for i in range(10))
    page = f"Home\nHome | News | Sports | About\n{body}\nAll rights reserved 2020\n# # # $$$"
    found = line_rules.measure(page)
    assert found["kept"] and found["cleaned"] == body and found["failed_lines"] == 4
    menu = "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(30))
    assert not line_rules.measure(menu)["kept"]
    assert line_rules.measure(menu)["cleaned"] == ""
