"""Queries of the operators of this subpackage, and the SQL that those which SQL can express must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lightloom.llm.bpe import encode_corpus
from lightloom.llm.entities import match_entities
from lightloom.llm.mixing import mix, mix_report
from lightloom.llm.neartime import lost_partners
from lightloom.llm.splitting import oversized, split
from lightloom.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return lost_partners(table(spark, d, "transit_shape"), table(spark, d, "detection"), table(spark, d, "frame"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return match_entities(table(spark, d, "catalog_source"), table(spark, d, "sky_object")).select("cat_id", "obj_id")


def p5_confidence(spark: SparkSession, d: str) -> DataFrame:
    return match_entities(table(spark, d, "catalog_source"), table(spark, d, "sky_object"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_report(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return oversized(table(spark, d, "documents"))


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p5_found, p5_confidence, p6_ids, p7_mix, p7_shares, p8_found, p8_pieces)}

ORACLE = {
    "p2_found": """
WITH d AS (SELECT DISTINCT det_id, obj_id, night_id, kind, tc_bjd_tdb AS t FROM detection
           WHERE tc_bjd_tdb IS NOT NULL AND NOT isnan(tc_bjd_tdb)),
a AS (SELECT shape_id, det_id, row_number() OVER (PARTITION BY shape_id ORDER BY abs(tc - t), det_id) AS r
      FROM transit_shape JOIN d USING (obj_id)
      WHERE kind = 'transit' AND NOT isnan(tc) AND abs(tc - t) <= 0.05),
b AS (SELECT det_id, frame_id, row_number() OVER (PARTITION BY det_id ORDER BY abs(t - bjd_tdb), frame_id) AS r
      FROM d JOIN frame USING (night_id) WHERE NOT isnan(bjd_tdb) AND abs(t - bjd_tdb) <= 0.01)
SELECT 'shape_detection' AS pairing, shape_id AS left_id, det_id AS right_id FROM a WHERE r = 1
UNION ALL SELECT 'detection_frame', det_id, frame_id FROM b WHERE r = 1""",
}
