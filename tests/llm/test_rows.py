"""Stages of the pipeline go by row: null and repeated keys, a key of a third of the rows, clashing
columns and empty tables. And letters of scripts that mark vowels."""

import random
import re
import timeit
import unicodedata

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemill.llm import language, near, packing, sketches
from telemill.llm.lines import dedup_lines

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def table(spark, rows):
    return spark.createDataFrame([(i, t, l, "s", None) for i, t, l in rows], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "the cat and the dog went over the hill", "en") for i in range(20)] + [(i, "der hund und die katze gehen heim", "de") for i in range(20)]
    return language.learn(table(spark, rows), F.lit(True))


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(n))


def texts_in(df):
    return sorted((row.doc_id, row.text) for row in df.select("doc_id", "text").collect() if row.doc_id is not None) + sorted(
        (row.text or "") for row in df.where("doc_id IS NULL").select("text").collect()
    )


def test_number_signs_are_no_letters(spark, model):
    rows = [(1, "½ ² ①", None), (2, "Ⅷ ⅷ ٣ 12", None), (3, "½ cat", None)]
    found = {row.doc_id: (row.lang_pred, row.score) for row in language.identify(table(spark, rows), model).collect()}
    assert found[1] == found[2] == ("und", 0.0)
    assert found[3] == ("en", 1.0)


def test_words_keep_their_vowel_signs():
    assert language.words_of("हिन्दी में, বাংলা! தமிழ் é x1y") == ["हिन्दी", "में", "বাংলা", "தமிழ்", "é", "x", "y"]


def test_words_of_every_script_at_the_speed_of_one():
    """A word is a letter and what follows of letters and marks, by the categories of code points;
    texts without large code points are not searched for them."""
    points = [0x41, 0xE9, 0x300, 0x378, 0x905, 0x94D, 0x2160, 0xD800, 0xFFDC, 0x10000, 0x1D400, 0x1E8D0, 0x1F642, 0x10FFFF]
    text = "".join(chr(x) + y + chr(z) for x in points for y in ("", "b", " ", "1", "_") for z in points)
    for one in (text, "".join(x for x in text if ord(x) < 1 << 16), "only ASCII_here 1x"):
        expected, at = [], None
        for place, kind in enumerate([unicodedata.category(x)[0] for x in one] + ["Z"]):
            if at is not None and kind not in "LM":
                expected.append(one[at:place])
                at = None
            at = place if at is None and kind == "L" else at
        assert language.words_of(one) == expected
    long = "Wörter, die é; sehr oft - vorkommen. " * 20_000

    def seconds(find):
        return min(timeit.repeat(lambda: find(long), number=1, repeat=3))

    assert seconds(language.words_of) < 2 * seconds(re.compile(r"[^\W\d_]\w*").findall)



def test_language_judges_each_row(spark, model):
    rows = [(None, "the cat and the dog", "en"), (None, "12 34", "en"), (None, None, "en"), (7, "½ ²", "en"), (7, "the dog", "de")]
    docs = table(spark, rows).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("spans", F.array(F.lit(2)))
    kept = language.in_a_language(docs.repartition(2), model)
    assert kept.columns == docs.columns
    assert texts_in(kept) == [(7, "the dog"), "the cat and the dog"]
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_language_with_a_key_of_a_third(spark, model):
    rows = [(None if i % 3 == 0 else i, "the dog" if i % 2 else "1 2 3", "en") for i in range(600)]
    kept = language.in_a_language(table(spark, rows), model)
    assert kept.count() == 300 and kept.where("doc_id IS NULL").count() == 100
    assert language.in_a_language(table(spark, []), model).collect() == []


def near_rows():
    """Classes of copies and near copies under null, repeated and own keys."""
    base = [prose(n) for n in range(6)]
    rows = [(None, base[0], "en"), (None, base[0], "en"), (None, base[0] + " more", "en"), (None, base[1], "en")]
    rows += [(5, base[2], "en"), (5, base[2], "en"), (5, base[3], "en"), (5, base[3] + " tail", "en"), (9, base[3], "en")]
    return rows + [(20, base[4], "en"), (21, base[4] + " x", "en"), (22, base[5], "en")], base


def test_near_duplicates_go_by_row(spark):
    rows, base = near_rows()
    docs = table(spark, rows).withColumn("row", F.lit("clash")).withColumn("kept", F.lit("clash")).withColumn("node", F.lit("clash"))
    left = near.one_of_each(docs.repartition(3))
    assert left.columns == docs.columns
    found = [text for text in (row.text for row in left.collect())]
    assert len(found) == 6
    # One of each class; a null key is the smallest.
    assert sum(text.startswith(base[0]) for text in found) == sum(text.startswith(base[3]) for text in found) == 1
    assert left.where("doc_id = 5").count() == 2 and left.where("doc_id IS NULL").count() == 2


def test_many_rows_of_one_key(spark):
    """A third of the rows have no key, in pairs of near copies: none meets another pair."""
    rows = [(None if n % 3 == 0 else n, prose(1000 + n, 30) + tail, "en") for n in range(300) for tail in ("", " tail")]
    left = near.one_of_each(table(spark, rows).repartition(4))
    assert left.count() == 300
    assert left.where("doc_id IS NULL").count() == 100


def test_shuffled_filter_agrees(spark, monkeypatch):
    rows, _ = near_rows()
    docs = table(spark, rows)
    expected = sorted(map(repr, texts_in(near.one_of_each(docs))))
    monkeypatch.setattr(near, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(near, "BROADCAST_TASKS", 0)
    assert sorted(map(repr, texts_in(near.one_of_each(docs)))) == expected


def test_lines_with_a_key_of_a_third(spark):
    rows = [(None if n % 3 == 0 else n, f"p {n}\nq {n}\nr {n}\n" + ("a\nb\nc" if n % 2 else "d"), "en") for n in range(90)]
    found = dedup_lines(table(spark, rows).repartition(3))
    assert found.agg(F.sum("n_removed")).first()[0] == 3 * 44
    assert dedup_lines(table(spark, [])).collect() == []


@pytest.mark.parametrize("part", ["null", "repeated", "empty"])
def test_the_whole_pipeline(spark, tmp_path, part):
    key = {"null": None, "repeated": 7, "empty": None}[part]
    rows = [] if part == "empty" else [(key if n % 3 == 0 else 100 + n, prose(n, 40) + ("\n" + prose(n + 1)) * (n % 2), "en") for n in range(60)]
    copies = [(key, text, "en") for _, text, _ in rows[:20]] + ([(key, "1 2 3", "en"), (key, None, None)] if rows else [])
    table(spark, rows + copies).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    starts = found.where("start = 0")
    assert starts.count() == len(rows)
    if rows:
        assert starts.where(F.col("doc_id").eqNullSafe(F.lit(key).cast("long"))).count() >= 20


def test_neighbours_of_rows_of_one_key(spark, monkeypatch):
    """A third of the rows have one key: they are split over buckets by their texts."""
    monkeypatch.setattr(sketches, "BUCKET_BYTES", 2000)
    rows = [(7 if n % 3 == 0 else n, prose(n % 100, 30) + f" {n}", "en") for n in range(300)]
    got = sketches.edited_versions(table(spark, rows).repartition(4))
    placed = sorted((key, text) for key, text, _ in rows)
    expected = []
    for i, (key, text) in enumerate(placed):
        after, k = placed[(i + 1) % len(placed)][1], len(text) // 4
        expected.append((key, text[: len(text) - k] + after[:k]))
    assert sorted((row.doc_id, row.edited) for row in got.collect()) == sorted(expected)


def test_packing_rows_of_one_key(spark, monkeypatch):
    """Groups stay small where all rows share a key and a text."""
    monkeypatch.setattr(packing, "PIECES_A_GROUP", 20)
    sizes = []
    monkeypatch.setattr(packing, "best_fit", lambda lengths, window, real=packing.best_fit: (sizes.append(len(lengths)), real(lengths, window))[1])
    pieces = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), (F.col("id") % 50 + 1).alias("length"), F.lit(5).cast("long").alias("ids_crc32"))
    packed = packing.pack(pieces.repartition(3), 64)
    by_group = packed.groupBy(F.shiftright("sequence_id", 24).alias("g")).count().collect()
    assert sum(row["count"] for row in by_group) == 400 and max(row["count"] for row in by_group) < 60
