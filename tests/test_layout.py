"""Line boundaries in profiles, box geometry and reading order, identifiers, replies."""

import math
import time

import pytest
from pyspark.sql import functions as F

from quire.functions import corrections as C
from quire.functions import geometry as G
from quire.functions import profiles as P
from quire.functions import text as T


def hump(length, centres, width=7.0):
    return [sum(1000 * math.exp(-0.5 * ((i - c) / width) ** 2) for c in centres) for i in range(length)]


def boundaries(spark, profile):
    row = spark.createDataFrame([(profile,)], "p array<double>").select(P.line_boundaries(F.col("p")).alias("b")).first()
    return [(x.top, x.bottom) for x in row.b]


def test_fused_pair_is_cut_in_its_trough(spark):
    found = boundaries(spark, hump(400, [40, 110, 180, 280, 315]))
    assert len(found) == 5 and 287 <= next(t for t, _ in found if 280 <= t <= 320) <= 307


@pytest.mark.parametrize("centres, tall, lines", [([40, 110, 180, 260, 295, 330], None, 6), ([40, 110, 180], 300, 4), ([40, 110, 180, 250, 320], None, 5)])
def test_triples_tall_lines_and_clean_ones(spark, centres, tall, lines):
    profile = hump(400, centres)
    if tall:
        profile = [a + b for a, b in zip(profile, hump(400, [tall], 12.0))]
    assert len(boundaries(spark, profile)) == lines


def test_empty_profiles(spark):
    assert boundaries(spark, [0.0] * 100) == [] == boundaries(spark, [])


def test_smoothing_divides_by_the_whole_width(spark):
    row = spark.createDataFrame([([7.0, 0.0, 0.0, 7.0, 14.0],)], "p array<double>").select(P.smooth(F.col("p"), 3).alias("s")).first()
    assert [round(x, 6) for x in row.s] == [round(x / 3, 6) for x in (7, 7, 7, 21, 21)]


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def box(*v):
    return G.box(*map(F.lit, v))


def test_boxes(spark):
    assert one(spark, G.iou(box(0, 0, 10, 10), box(5, 0, 15, 10))) == pytest.approx(1 / 3)
    assert one(spark, G.iou(box(0, 0, 0, 0), box(0, 0, 0, 0))) == 0
    assert tuple(one(spark, G.contained(box(10, 10, 90, 90), box(0, 20, 80, 80), box(30, 30, 60, 60)))) == (True, True)
    assert [tuple(b) for b in one(spark, G.halves(F.lit(1000), F.lit(500)))] == [(20, 5, 490, 495), (510, 5, 980, 495)]
    assert one(spark, G.region_types(F.lit(3))) == ["single"] * 3 and one(spark, G.clamp(F.lit(9), F.lit(1), F.lit(5))) == 5


def test_reading_order(spark):
    rows = [(400, 30, 700, 500, "right"), (0, 0, 700, 20, "header"), (10, 28, 300, 480, "left"), (0, 520, 700, 560, "foot")]
    frame = spark.createDataFrame([(rows,)], "b array<struct<x1:int,y1:int,x2:int,y2:int,name:string>>")
    assert [b.name for b in frame.select(G.reading_order(F.col("b")).alias("o")).first().o] == ["header", "left", "right", "foot"]


def test_identifiers(spark):
    assert one(spark, T.page_id(F.lit(12345))) == "page_12345" and one(spark, T.page_id(F.lit(7))) == "page_0007"
    assert one(spark, T.line_id(F.lit("r"), F.lit(1234))) == "r/line_1234"
    assert one(spark, T.base_id(F.lit("page_0007_human"))) == "page_0007" and one(spark, T.page_number(F.lit("page_0400_auto"))) == 400
    assert one(spark, T.repoint_key(F.lit("column_2/line_004"))) == "region_02_right/line_004" and one(spark, T.repoint_key(F.lit("x"))) == "x"
    assert one(spark, T.tag_pages(F.lit("page_0001 page_0002_auto page_0003"), ["0001"])) == "page_0001_human page_0002_auto page_0003_auto"


def test_replies(spark):
    reply = "```\n1. one\n2\ttwo\nnoise\n2) again\n9 beyond\n```"
    assert tuple(one(spark, C.parse_rewrite(F.lit(reply), F.lit(3)))) == ({1: "one", 2: "two"}, False)
    assert one(spark, C.parse_rewrite(F.lit(reply), F.lit(2))).parse_ok
    edits = 'So: {"1": {"a": "b"}, "x": {"c": "d"}, "7": {"e": "f"}, "2": 3} done'
    assert tuple(one(spark, C.parse_minimal_edit(F.lit(edits), F.lit(2)))) == ({1: {"a": "b"}}, True)
    assert tuple(one(spark, C.parse_minimal_edit(F.lit("none"), F.lit(2)))) == ({}, False)


def test_a_long_reply_is_parsed_once(spark):
    n = 1500
    reply = "\n".join([f"{i}. line {i} {'word ' * 20}" for i in range(n, 0, -1)] + ["7. again", "0. none", f"{n + 1}. beyond"])
    frame = spark.createDataFrame([(reply, n)], "reply string, n int")
    parsed = frame.select(C.parse_rewrite(F.col("reply"), F.col("n")).alias("x"))
    start = time.time()
    found = parsed.first().x
    assert time.time() - start < 8
    assert found.parse_ok and len(found.lines) == n and found.lines[7].startswith("line 7 ") and found.lines[n].startswith(f"line {n} ")
