"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows,
empty tables and columns with clashing names."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemill.llm import bytebpe, counts, exact, language, lattice, lines, near, packing, queries, shards, sketches
from telemill.llm.components import components

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
BYTE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))
ODD = ["", "   ", "\n\n\n", "a", "<|endoftext|> <s> x", "ünï ▁ co▁de  \t x\r\ny", "日本語 テキスト", "\x00\x1c  z", "é ́x", "🙂👍🏽 a's", "no" * 3000]


def table(spark, rows):
    return spark.createDataFrame([(i, t, l, "s", None) for i, t, l in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, odd and long texts, repeated rows, and columns named like ours."""
    rows = [(None, None, None), (5, None, "en"), (3, LONG, "en"), (3, LONG, "en"), (4, "the cat sat on the mat", None), (9, "the cat sat on the mat", "en")]
    rows += [(100 + i, text, ("en", "de")[i % 2]) for i, text in enumerate(ODD)]
    docs = table(spark, rows)
    for name in ("row", "node", "band", "shard", "tokens", "block", "size", "label", "digest", "key", "position", "kept", "ids", "bucket", "place", "n_lines", "tm_group"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *names):
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)


def texts_of(docs):
    return [(row.doc_id, row.text or "") for row in docs.select("doc_id", "text").collect()]


def given(docs, make):
    return sorted((make(doc_id, text) for doc_id, text in texts_of(docs)), key=repr)


# Packing


def word_ids(text):
    return packing._tokenizer(WORD).encode(text, add_special_tokens=False).ids + [1]


def check_packing(pieces, docs, window):
    ids = defaultdict(list)
    for doc_id, text in texts_of(docs):
        ids[doc_id].append(word_ids(text))
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for row in pieces.collect():
        by_sequence[row.sequence_id].append((row.offset, row.length))
        by_document[row.doc_id].append((row.start, row.length, row.ids_crc32, row.doc_tokens))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert by_document.keys() == ids.keys()
    for doc_id, parts in by_document.items():
        expected = []
        for own in ids[doc_id]:
            for start in range(0, len(own), window):
                piece = own[start : start + window]
                expected.append((start, len(piece), crc32(np.array(piece, "<u4").tobytes()), len(own)))
        assert sorted(parts) == sorted(expected)
    return len(by_sequence)


@pytest.mark.parametrize("window", [2048, 64])
def test_packing(spark, odd, window):
    pieces = packing.packed_documents(odd, WORD, 1, window)
    n = check_packing(pieces, odd, window)
    total = sum(len(word_ids(text)) for _, text in texts_of(odd))
    assert n <= -(-total // window) * 1.1 + 1


def test_packed_sequences(spark, odd):
    pieces = packing.pack(packing.token_pieces(odd, WORD, 1, 64, keep_ids=True), 64)
    rows = packing.sequences(pieces, 64, padding=7).collect()
    assert all(len(row.ids) == 64 for row in rows)
    ids = Counter(x for row in rows for x in row.ids)
    expected = Counter(x for _, text in texts_of(odd) for x in word_ids(text))
    assert ids - expected == Counter({7: 64 * len(rows) - expected.total()})


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(3)
    lengths = sorted(rng.integers(1, 101, 400).tolist(), reverse=True)
    room, expected = [], []
    for length in lengths:
        fitting = [(left, i) for i, left in enumerate(room) if left >= length]
        if not fitting:
            fitting, _ = [(100, len(room))], room.append(100)
        tightest = min(left for left, _ in fitting)
        room[next(i for left, i in fitting if left == tightest)] -= length
        expected.append(100 - tightest)
    assert packing.best_fit(lengths, 100)[1] == expected
    assert len(set(packing.best_fit(lengths, 100)[0])) == len(room)


# Tokens


def test_token_counts(spark, odd):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECE)
    got = found(counts.token_counts(odd, PIECE, limit=5), "doc_id", "n_bytes", "n_tokens", "over_limit")

    def row(doc_id, text):
        n = len(model.encode(text))
        return doc_id, len(text.encode()), n, n > 5

    assert got == given(odd, row)


def test_byte_bpe(spark, odd):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.vocabulary(BYTE), special_tokens={})
    coded = bytebpe.decode(bytebpe.encode(odd, BYTE, public_tokenizers.PATTERN), BYTE)
    got = found(coded, "doc_id", "ids", "decoded")
    assert got == given(odd, lambda i, t: (i, encoding.encode_ordinary(t), bytearray(t.encode())))


def test_letters_newer_than_tiktoken_knows():
    import regex
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.vocabulary(BYTE), special_tokens={})
    matcher = regex.compile(public_tokenizers.PATTERN)
    known = bytebpe.PreTokenIds(BYTE)
    for start in range(0x10000, 0x33000, 97):
        text = "".join(f"a{chr(c)}a1{chr(c)} " for c in range(start, start + 97))
        parts = bytebpe.pre_tokens(text, matcher)
        known.learn(set(parts))
        assert np.frombuffer(b"".join(known[x] for x in parts), np.int32).tolist() == encoding.encode_ordinary(text)


def test_a_model_needs_ranks_without_gaps():
    with pytest.raises(ValueError):
        bytebpe.model({b"a": 0, b"b": 2})


# Language model


def test_lattice_sums_all_segmentations():
    scores = {"▁": -1.0, "▁a": -2.0, "a": -1.5, "b": -2.5, "ab": -3.0, "▁ab": -2.2} | {x: -6.0 for x in lattice.BYTES}
    model = lattice.Lattice(scores)

    def ways(text):
        if not text:
            return [0.0]
        out = [scores[text[:n]] + rest for n in range(1, len(text) + 1) if text[:n] in scores for rest in ways(text[n:])]
        if text[0] not in scores:
            out += [-6.0 * len(text[0].encode()) + rest for rest in ways(text[1:])]
        return out

    for word in ("a", "ab", "abab", "éa", "b"):
        assert math.isclose(model.word(word), math.log(sum(map(math.exp, ways("▁" + word)))))


def test_scores(spark, odd):
    learn = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(True))
    got = {(r.doc_id, r.n_tokens): r for r in lattice.scored(odd.withColumn("learn", learn), PIECE).collect()}
    words = {(i, t): re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t)) for i, t in texts_of(odd)}
    c, ends = Counter(), 0
    for i, t in texts_of(odd):
        if i is None or i % 2 == 1:
            c.update(words[i, t])
            ends += 1
    n, v = c.total() + ends, len(c) + 1
    assert sum(1 for _ in texts_of(odd)) == lattice.scored(odd.withColumn("learn", learn), PIECE).count()
    for (i, _), own in words.items():
        row = got[i, len(own) + 1]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own) + math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert row.n_known == sum(c[w] > 0 for w in own) + 1 and row.train_tokens == n
        assert row.score < 0
    scores = lattice.scored(table(spark, [(1, "x y", None)]).withColumn("learn", F.lit(False)), PIECE).first()
    assert (scores.train_tokens, scores.n_known) == (0, 0) and scores.score < 0


# Near duplicates


def near_classes(rows):
    """Classes by comparing all pairs: the smallest key of each."""
    hashes = near._WordHashes()
    bags = [near.bag(text.split(), hashes) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near.overlap(bags[i], bags[j]) >= near.SIMILARITY:
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        classes[root(i)].append(key)
    return [(key, min(x, key=lambda k: (k is not None, k or 0)), len(x)) for x in classes.values() for key in x]


def test_near_duplicates(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(6):
        base = rng.integers(0, 5000, 120).tolist()
        for edits in (0, 0, 1, 1, 2, 2, 3, 4, 6, 9, 15):
            words = list(base)
            for at in rng.integers(0, 120, edits):
                words[at] = 10_000 + int(rng.integers(0, 90_000))
            rows.append((len(rows), " ".join(f"w{x}" for x in words)))
    docs = table(spark, [(i, t, None) for i, t in rows]).repartition(4)
    got = near.near_duplicates(docs)
    assert found(got, "doc_id", "class_id", "class_size") == sorted(near_classes(rows), key=repr)
    assert {r.doc_id for r in got.where("kept").collect()} == {r.class_id for r in got.collect()}


def test_near_duplicates_of_odd_rows(spark, odd):
    got = near.near_duplicates(odd)
    assert sorted(found(got, "doc_id", "class_id", "class_size"), key=repr) == sorted(near_classes(texts_of(odd)), key=repr)
    assert all(n == 1 for n in Counter(r.class_id for r in got.where("kept").collect()).values())
    left = {r.doc_id for r in near.one_of_each(odd).collect()}
    assert left == {r.class_id for r in got.collect()}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    one = rng.integers(1, 2**62, 80).astype(np.uint64)
    for most in (2, 40):
        times = rng.integers(1, most, 80)
        other = np.maximum(1, times + rng.integers(-most // 2, most // 2 + 1, 80) * (rng.random(80) < 0.4))
        bags = [(np.sort(one), x[np.argsort(one)]) for x in (times, other)]
        a, b = (near.signatures(np.zeros(80, np.int64), *x, 1, 8192)[0] for x in bags)
        assert abs((a == b).mean() - near.overlap(*bags)) < 0.02


def test_blocks_of_open_documents(spark, monkeypatch):
    monkeypatch.setattr(near, "OPEN_A_BLOCK", 2)
    monkeypatch.setattr(near, "MEMBERS_A_SALT", 3)
    monkeypatch.setattr(near, "PAIRS_A_SALT", 2)
    monkeypatch.setattr(near, "BROADCAST_TASKS", 0)
    test_near_duplicates(spark)


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = dict(found(components(spark.createDataFrame(links, "a BIGINT, b BIGINT")), "node", "label"))
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


# Language identification


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    lengths = np.array([4, 0, 1, 6])
    scores = (rng.normal(size=(lengths.sum(), 3)) * 6).astype(np.float32)
    labels, at = language.viterbi(scores, lengths), 0

    def worth(own, path):
        return sum(own[i, x] for i, x in enumerate(path)) - language.SWITCH * sum(x != y for x, y in zip(path, path[1:]))

    for n in lengths:
        own = scores[at : at + n]
        paths = np.stack(np.meshgrid(*[range(3)] * n), -1).reshape(-1, n) if n else []
        if n:
            assert math.isclose(worth(own, labels[at : at + n]), max(worth(own, x) for x in paths), rel_tol=1e-5)
        at += n


def test_languages_and_spans(spark):
    words = {"en": "the and that with this have from they", "de": "und nicht der über schön weiß auch für", "ru": "это не что как они был для"}
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        lang = list(words)[i % 3]
        rows.append((i, " ".join(rng.choice(words[lang].split(), 30)), lang))
    model = language.learn(table(spark, rows), F.lit(True))
    mixed = " ".join(["the"] * 20 + ["nicht"] * 30 + ["это"] * 10)
    docs = table(spark, [*rows, (900, mixed, None), (901, None, "en"), (902, "12 !", "en"), (903, "日本", "en"), (904, "", None)])
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and got[i].score == 1 for i, _, lang in rows)
    assert [tuple(x) for x in got[900].spans] == [(0, 19, "en"), (20, 49, "de"), (50, 59, "ru")]
    assert got[900].lang_pred == "de" and math.isclose(got[900].score, 150 / 240)
    assert [(got[i].lang_pred, got[i].score) for i in (901, 902, 904)] == [("und", 0.0)] * 3
    assert got[903].lang_pred in words and got[903].score == 0
    left = {r.doc_id for r in language.in_a_language(docs, model).collect()}
    assert left == {i for i, _, _ in rows} | {900}


def test_languages_of_odd_rows(spark, odd, empty):
    got = language.identify(odd, language.learn(odd, F.lit(True)))
    assert got.count() == odd.count()
    none = language.identify(odd, language.learn(empty, F.lit(True)))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}


# Lines


def without_later_windows(rows):
    first, removed = {}, defaultdict(set)
    keyed = [(key is not None, key or 0, i) for i, (key, _) in enumerate(rows)]
    for given_key, key, i in sorted(keyed):
        own = rows[i][1].split("\n")
        for p in range(len(own) - 2):
            place = (given_key, key, p)
            if first.setdefault(tuple(own[p : p + 3]), place) != place:
                removed[i].update((p, p + 1, p + 2))
    return ["\n".join(x for p, x in enumerate(text.split("\n")) if p not in removed[i]) for i, (_, text) in enumerate(rows)]


def test_repeated_lines(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "\n".join(rng.choice(list("abcde"), rng.integers(0, 14)))) for i in range(60)] + [(1000, "x\nx\nx\nx\nx")]
    docs = table(spark, [(i, t, None) for i, t in rows]).repartition(4)
    got = found(lines.dedup_lines(docs), "doc_id", "text")
    assert got == sorted(zip([i for i, _ in rows], without_later_windows(rows)), key=repr)


def test_repeated_lines_of_odd_rows(spark, odd):
    got = lines.dedup_lines(odd)
    assert set(odd.columns) <= set(got.columns) and got.count() == odd.count()
    assert got.where("doc_id = 5").first().text is None and got.where("doc_id = 5").first().n_lines == 0
    assert got.where("doc_id = 102").first().n_removed == 3  # its second window is a later one
    assert got.where("shard <> 'clash'").count() == 0


def test_repeated_lines_of_rows_that_share_a_key(spark):
    """Repeated and null keys with different texts: each row loses its own later windows only."""
    rows = [(7, "p\nq\nr\ns"), (7, "x\ny\nz\nw"), (3, "x\ny\nz"), (None, "a\nb\nc"), (None, "d\ne\nf\na\nb\nc"), (9, "d\ne\nf"), (8, "k\nl\nm"), (8, "k\nl\nm")]
    got = found(lines.dedup_lines(table(spark, [(i, t, None) for i, t in rows]).coalesce(1)), "doc_id", "text", "n_removed")
    left = [(t, 0) for _, t in rows]
    left[1], left[4], left[5], left[7] = ("w", 3), ("d\ne\nf", 3), ("", 3), ("", 3)
    assert got == sorted(((i, *x) for (i, _), x in zip(rows, left)), key=repr)


# Exact duplicates


def test_exact_duplicates(spark, odd):
    groups = defaultdict(list)
    for doc_id, text in texts_of(odd):
        groups[text].append(doc_id)
    expected = []
    for text, ids in groups.items():
        keep = max((x for x in ids if x is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = [x == keep and ids.index(x) == i for i, x in enumerate(ids)]
        expected += [(x, keep, len(ids), kept, digest) for x, kept in zip(ids, stays)]
    got = found(exact.exact_duplicates(odd), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(expected, key=repr)


def test_cuckoo_index():
    index, rng = exact.CuckooIndex(2), np.random.default_rng(6)
    live = {}
    for n in range(5000):
        digest = hashlib.sha256(str(rng.integers(0, 3000)).encode()).digest()
        if n % 3 and digest in live:
            assert index.delete(digest) == live.pop(digest)
        elif digest not in live:
            index.insert(digest, n)
            live[digest] = n
        assert index.get(digest) == live.get(digest)
    assert dict(index.items()) == live and len(index) == len(live)
    assert index.buckets > 2 and index.delete(b"x" * 32) is None
    # Same tag and buckets, other content: a hit of the filter is verified.
    twins = [b"\x01\x02" + b"\x00" * 8 + bytes([i]) * 22 for i in range(8)]
    for i, digest in enumerate(twins[:6]):
        index.insert(digest, i)
    assert [index.get(x) for x in twins] == [0, 1, 2, 3, 4, 5, None, None]


# Fingerprints


def test_sketches_recover_differences():
    rng = np.random.default_rng(9)
    for n in (0, 1, 5, 40, 900):
        shared, left, right = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (50, n, n // 2))
        versions = (sketches.Version(np.concatenate(x)) for x in ((shared, left), (right, shared)))
        one, two = sketches.difference(*versions)
        assert set(one.tolist()) == set(left.tolist()) and set(two.tolist()) == set(right.tolist())
    assert sketches.Sketch.of(left, 24).minus(sketches.Sketch.of(right, 24)).peeled() is None


def test_edited_versions(spark, odd, monkeypatch):
    rows = sorted(((-(1 << 63) if i is None else i, t, i) for i, t in texts_of(odd)))
    expected = []
    for n, (_, text, doc_id) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]

        def like(x, y):
            a, b = (Counter(sketches.paragraphs(t)) for t in (x, y))
            return (a & b).total() / (a | b).total() if a or b else 1.0

        expected.append((doc_id, len(text), edited, round(like(text, edited), 9), round(like(text, after), 9)))
    for n_buckets in (1, 4):
        monkeypatch.setattr(sketches, "BUCKETS", n_buckets)
        got = sketches.edited_versions(odd)
        rounded = [(r.doc_id, r.n_chars, r.edited, round(r.near_edited, 9), round(r.near_next, 9)) for r in got.collect()]
        assert sorted(rounded, key=repr) == sorted(expected, key=repr)
    prints = {r.doc_id: r.fingerprint for r in sketches.fingerprints(odd).collect()}
    assert prints[4] == prints[9] != prints[3]
    assert {r.doc_id: r.fingerprint for r in got.collect()} == prints


def test_an_edit_changes_few_digests():
    """Single paragraphs of several scripts, and texts that repeat themselves."""
    rng = np.random.default_rng(11)
    words = ["".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 9))) for _ in range(500)]
    texts = [" ".join(rng.choice(words, n)) for n in (40, 300, 3000)]
    texts += ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 900, n)) for n in (300, 9000)]
    texts += ["".join(chr(0x1F300 + int(c)) for c in rng.integers(0, 200, 900)), "a" * 5000, "no" * 3000, "x\n" * 50 + "abc" * 5000]
    for text in texts:
        parts = sketches.paragraphs(text)
        whole = "".join(parts)
        assert whole == text.replace("\n", "") and max(map(len, parts)) <= sketches.LONGEST and len(parts) >= len(text) / (sketches.LONGEST + 6)
        for at in (0, len(text) // 3, len(text) // 2, len(text) - 1):
            for edited in (text[:at] + "Q" + text[at:], text[:at] + text[at + 1 :], text[:at] + "Q" + text[at + 1 :]):
                versions = [sketches.Version(sketches.digests(x)) for x in (text, edited)]
                apart = sum(map(len, sketches.difference(*versions)))
                assert apart <= 20 and sketches.likeness(*versions) >= 1 - 20 / len(parts)
        kept = len(text) - len(text) // 4
        quarter = text[:kept] + "".join(chr(c) for c in rng.integers(0x3B1, 0x3C9, len(text) // 4))
        assert sketches.likeness(*(sketches.Version(sketches.digests(x)) for x in (text, quarter))) > 0.4
        for end in (quarter[kept:], "", ". " + text[:90], "\n" + text, text[-40:]):
            changed, anew = sketches.Text(text).ending_in(kept, end), sketches.Version(sketches.digests(text[:kept] + end))
            assert changed.digests.tolist() == anew.digests.tolist()
            assert all(changed.sketch(cells).text() == anew.sketch(cells).text() for cells in (24, 96))
    assert sketches.paragraphs("") == [] and sketches.paragraphs(" " * 500) == []
    assert sketches.paragraphs("One. Two.\n\nThree") == ["One.", "Two.", "Three"]


def test_one_document_follows_itself(spark):
    row = sketches.edited_versions(table(spark, [(1, "abcd", None)])).first()
    assert (row.edited, row.near_next) == ("abca", 1.0)


# Shards


def brute_capacity(sizes, n):
    def fits(capacity):
        used, left = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > left:
                used, left = used + 1, capacity
            left -= size
        return used <= n

    return next(c for c in range(max([*sizes, 0]), sum(sizes) + 1) if fits(c))


def test_minimax_cuts():
    rng = np.random.default_rng(7)
    for n in (1, 3, 8):
        for sizes in ([], [5], rng.integers(0, 50, 40).tolist()):
            capacity, ends = shards.minimax_cuts(sizes, n)
            assert capacity == (brute_capacity(sizes, n) if sizes else 0)
            assert len(ends) == n and ends[-1] == len(sizes) and ends == sorted(ends)
            assert all(sum(sizes[a:b]) <= capacity for a, b in zip([0, *ends], ends))


def test_shards(spark, odd):
    rows = [(i, f"text {i % 400} " * (1 + i % 7), None) for i in range(3000)] + [(9000 + i, "hot", None) for i in range(2000)]
    for docs in (table(spark, rows).repartition(4), odd):
        got = shards.shards(docs, 40).collect()
        assert sorted(r.doc_id or -1 for r in got) == sorted(i or -1 for i, _ in texts_of(docs))
        texts = dict(texts_of(docs))
        by_shard, by_text, total = defaultdict(list), defaultdict(set), Counter()
        for r in got:
            text = texts[r.doc_id]
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 16, crc32(text.encode()), "bytes", None)
            by_shard[r.shard].append(r.slot)
            by_text[text].add(r.shard)
            total[r.shard] += r.size
        assert all(sorted(x) == list(range(len(x))) for x in by_shard.values()) and set(by_shard) <= set(range(40))
        assert all(len(x) == 1 for x in by_text.values())
        groups = Counter()
        for r in got:
            groups[texts[r.doc_id]] += r.size
        assert max(total.values()) <= max(groups.values()) + -(-sum(total.values()) // 40)


def test_even_cuts():
    rng = np.random.default_rng(10)
    for n in (1, 3, 8):
        for sizes in ([], [5], [5, 5, 5], [1] * 9 + [30], rng.integers(1, 50, 9).tolist(), rng.integers(1, 50, 400).tolist()):
            capacity, ends = shards.minimax_cuts(sizes, n)
            parts = [sum(sizes[a:b]) for a, b in zip([0, *ends], ends)]
            assert sum(parts) == sum(sizes) and max(parts) <= capacity and sum(x > 0 for x in parts) == min(n, len(sizes))
            assert len(sizes) < 400 or max(parts) - min(parts) <= 2 * max(sizes)
    assert shards.apart([1, 9, 1, 3, 1, 1], 4) == ([1, 3], []) and shards.apart([2, 2], 2) == ([], [0, 1])
    assert shards.apart([5, 6], 3) == ([1, 0], []) and shards.apart([], 3) == ([], [])
    capacity, ends = shards.minimax_cuts([1] * 20, 4, [4, 6])
    parts = [own + b - a for own, a, b in zip([0, 0, 4, 6], [0, *ends], ends)]
    assert capacity == 8 and sum(parts) == 30 and set(parts) == {7, 8}


@pytest.mark.parametrize("hot", [[4000], [600], [200], [120], [500, 3000]])
def test_shards_beside_hot_groups(spark, hot):
    """A group above its share leaves the other shards nearly equal, and none of them empty."""
    rows = [f"text {i:06}" for i in range(8000)] + [f"hot {n:07}" for n in hot for _ in range(n)]
    docs = table(spark, [(i, text, None) for i, text in enumerate(rows)])
    total = Counter()
    for r in shards.shards(docs, 40).select("shard", "size").collect():
        total[r.shard] += r.size
    sizes = [total[i] for i in range(40)]
    above = [n * 27 for n in hot if n > 200]
    assert sorted(sizes)[40 - len(above) :] == pytest.approx(sorted(above), rel=0.01)
    others = sorted(sizes)[: 40 - len(above)]
    assert 0 < others[-1] <= 1.05 * others[0]


# Empty tables, queries and the pipeline


def test_empty_tables(spark, empty):
    model = language.learn(empty, F.lit(True))
    results = [
        packing.packed_documents(empty, WORD, 1), counts.token_counts(empty, PIECE), bytebpe.encode(empty, BYTE, public_tokenizers.PATTERN),
        lattice.scored(empty.withColumn("learn", F.lit(True)), PIECE), near.near_duplicates(empty), language.identify(empty, model),
        lines.dedup_lines(empty), exact.exact_duplicates(empty), sketches.edited_versions(empty), shards.shards(empty),
    ]
    assert [df.count() for df in results] == [0] * 10


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in queries.documents(spark, folder).collect()}
    rows = [r for r in queries.language(spark, folder).collect() if r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in rows) >= 0.98 * len(rows) > 0


def test_pipeline(spark):
    """Each stage against brute force on what the stage before kept."""
    folder = "/root/testdata/sf0.001"
    docs = queries.documents(spark, folder).select(SCHEMA.replace(" BIGINT", "").replace(" STRING", "").split(", "))
    names = docs.columns
    kept = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    assert kept.columns == names
    with_letters = {i for i, t in texts_of(docs) if re.search(r"[^\W\d_]", t)}
    assert {i for i, _ in texts_of(kept)} == with_letters
    before = sorted(texts_of(kept))
    cut = corpus_pipeline.STAGES[1][1](spark, kept, folder)
    assert cut.columns == names
    expected = [(i, new) for (i, old), new in zip(before, without_later_windows(before)) if new or not old]
    assert sorted(texts_of(cut)) == expected
    one = corpus_pipeline.STAGES[2][1](spark, cut, folder)
    assert one.columns == names
    assert {i for i, _ in texts_of(one)} == {first for _, first, _ in near_classes(sorted(texts_of(cut)))}
    check_packing(corpus_pipeline.run(spark, folder), one, queries.WINDOW)


@pytest.mark.parametrize("name", ["op3_byte_bpe", "op9_fingerprints"])
def test_digest_columns(spark, name):
    folder = "/root/testdata/sf0.001"
    rows = queries.QUERIES[name](spark, folder).collect()
    texts = dict(texts_of(queries.documents(spark, folder)))
    assert len(rows) == len(texts)
    for row in rows:
        if name == "op3_byte_bpe":
            assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
        else:
            assert len(base64.b64decode(row.fingerprint)) == 16 * sketches.CELLS and 0 <= row.near_next <= 1
