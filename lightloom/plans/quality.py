"""Queries of the operators that check measurements, references and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lightloom.operators.orphans import Parent, orphan_report, orphans, review_orphans
from lightloom.operators.regions import around_objects
from lightloom.operators.spikes import implausible_photometry
from lightloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return implausible_photometry(table(spark, d, "matched_epoch"), table(spark, d, "frame"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return review_orphans(table(spark, d, "detection_review_orphan"), table(spark, d, "sky_object"), table(spark, d, "night"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p3_found(spark, d), "detection_review_orphan")


def p3_partial(spark: SparkSession, d: str) -> DataFrame:
    """Detections whose (obj_id, night_id) was never measured, by MATCH PARTIAL: a null night asks for the object alone."""
    measured = table(spark, d, "matched_epoch").select("star_id", "night_id")
    found = orphans(table(spark, d, "detection"), "det_id", ("obj_id", "night_id"), (Parent(measured, ("star_id", "night_id")),), "partial")
    return found.select("ref_id", "mask", "part")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return around_objects(table(spark, d, "sky_object"), table(spark, d, "sky_region"))


QUERIES = {f.__name__: f for f in (p1_found, p3_found, p3_report, p3_partial, p4_found)}

_P3 = """
WITH r AS (SELECT DISTINCT review_id, obj_id, night_id, saved_at FROM detection_review_orphan)
SELECT review_id, 'obj_id' AS ref_field, strftime(saved_at, '%Y-%m') AS saved_month FROM r
WHERE obj_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sky_object o
  WHERE o.obj_id = r.obj_id AND o.removed_at IS NULL AND o.loaded_at <= r.saved_at)
UNION SELECT review_id, 'night_id', strftime(saved_at, '%Y-%m') FROM r
WHERE night_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM night n
  WHERE n.night_id = r.night_id AND n.removed_at IS NULL AND n.loaded_at <= r.saved_at)"""

ORACLE = {
    "p3_found": _P3,
    "p3_report": f"""
SELECT ref_field, saved_month, count(*) AS n_orphans, 'detection_review_orphan' AS ref_table FROM ({_P3}) GROUP BY 1, 2""",
    "p3_partial": """
WITH d AS (SELECT DISTINCT det_id, obj_id, night_id FROM detection),
m AS (SELECT DISTINCT star_id, night_id FROM matched_epoch)
SELECT det_id AS ref_id, 'xx' AS mask, 'obj_id+night_id' AS part FROM d WHERE obj_id IS NOT NULL AND night_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM m WHERE m.star_id = d.obj_id AND m.night_id = d.night_id)
UNION SELECT det_id, 'x-', 'obj_id' FROM d WHERE obj_id IS NOT NULL AND night_id IS NULL
  AND NOT EXISTS (SELECT 1 FROM m WHERE m.star_id = d.obj_id)
UNION SELECT det_id, '-x', 'night_id' FROM d WHERE obj_id IS NULL AND night_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM m WHERE m.night_id = d.night_id)""",
    "p4_found": """
WITH o AS (SELECT obj_id, ((ra % 360) + 360) % 360 AS ra, dec, cos(radians(dec)) * cos(radians(ra)) AS x,
             cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM sky_object
           WHERE ra IS NOT NULL AND dec IS NOT NULL AND NOT isnan(ra) AND NOT isnan(dec)),
c AS (SELECT *, cos(radians(dec_centre)) * cos(radians(ra_centre)) AS cx, cos(radians(dec_centre)) * sin(radians(ra_centre)) AS cy,
        sin(radians(dec_centre)) AS cz FROM sky_region)
SELECT 'near' AS relation, a.obj_id AS key_a, b.obj_id AS key_b FROM o a JOIN o b
  ON a.obj_id < b.obj_id AND b.dec BETWEEN a.dec - 0.0014 AND a.dec + 0.0014
WHERE degrees(2 * asin(least(1, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) / 2))) * 3600 <= 5
UNION ALL SELECT 'inside', region_id, obj_id FROM o JOIN c
  ON (outline = 'circle' AND degrees(2 * asin(least(1, sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2) / 2))) <= radius_deg + 1e-9)
  OR (outline = 'box' AND dec BETWEEN dec_from - 1e-9 AND dec_to + 1e-9 AND CASE WHEN ra_from <= ra_to
      THEN ra BETWEEN ra_from - 1e-9 AND ra_to + 1e-9 ELSE ra >= ra_from - 1e-9 OR ra <= ra_to + 1e-9 END)""",
}
