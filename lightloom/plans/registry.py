"""Registration of a query with the SQL that must give the same rows, over shared named inputs."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lightloom.functions.scalar import clean
from lightloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_N = "CASE WHEN isnan({0}) OR isinf({0}) THEN NULL ELSE {0}::DOUBLE END AS {0}"

#: SQL of the named inputs, in the order in which one may use another.
INPUTS = {
    "fr": "SELECT frame_id, night_id, frame_index, file_name, date_obs, exptime::DOUBLE AS exptime, n_sources, kept, "
    + ", ".join(_N.format(c) for c in ("bjd_tdb", "airmass", "fwhm")) + " FROM frame",
    "obj": "SELECT obj_id, name, CASE WHEN NOT isnan(ra) AND NOT isinf(ra) THEN ((ra % 360) + 360) % 360 END AS ra, CASE WHEN NOT isnan(dec) AND NOT isinf(dec) THEN dec END AS dec, gaia_id, CASE WHEN isnan(mean_mag) OR mean_mag > 40 THEN NULL ELSE mean_mag::DOUBLE END AS mag, "
    "n_nights, obj_class, CASE WHEN isnan(period) THEN NULL ELSE period END AS period, known, known_name, known_type, status, loaded_at, updated_at, removed_at "
    "FROM sky_object",
    "pos": "SELECT * FROM obj WHERE ra IS NOT NULL AND dec IS NOT NULL",
    "ep": "SELECT night_id, star_id, frame_index, aper, flux, fluxerr, snr::DOUBLE AS snr, flags FROM (SELECT *, row_number() OVER "
    "(PARTITION BY night_id, star_id, frame_index, aper ORDER BY loaded_at DESC, flux DESC NULLS LAST) AS rn FROM matched_epoch) "
    "WHERE rn = 1 AND flux > 0 AND NOT isnan(flux) AND NOT isinf(flux) AND fluxerr > 0 AND NOT isnan(fluxerr) AND NOT isinf(fluxerr)",
    "det": "SELECT det_id, obj_id, night_id, mn_run_id, kind, flags, status, loaded_at, "
    + ", ".join(_N.format(c) for c in ("snr", "depth", "duration_h", "tc_bjd_tdb")) + " FROM (SELECT *, row_number() OVER "
    "(PARTITION BY det_id ORDER BY loaded_at DESC) AS rn FROM detection) WHERE rn = 1",
    "shape": "SELECT shape_id, obj_id, n_points, fit_input, converged, t14_lower_limit, computed_at, "
    + ", ".join(_N.format(c) for c in ("tc", "tc_err", "depth", "t14_h")) + " FROM transit_shape",
}


class Inputs:
    """The named inputs as plans; missing numbers are null, of repeated rows the last loaded counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @property
    def fr(self) -> DataFrame:
        keep = ["frame_id", "night_id", "frame_index", "file_name", "date_obs", F.col("exptime").cast("double").alias("exptime"), "n_sources", "kept"]
        return self.table("frame").select(*keep, *(clean(F.col(c)).alias(c) for c in ("bjd_tdb", "airmass", "fwhm")))

    @property
    def obj(self) -> DataFrame:
        """All objects, also those without a place."""
        mag, p = F.col("mean_mag").cast("double"), F.col("period")
        return self.table("sky_object").select(
            "obj_id", "name", F.pmod(clean(F.col("ra")), F.lit(360.0)).alias("ra"), clean(F.col("dec")).alias("dec"), "gaia_id", F.when(~F.isnan(mag) & (mag <= 40), mag).alias("mag"),
            "n_nights", "obj_class", F.when(~F.isnan(p), p).alias("period"), "known", "known_name", "known_type", "status", "loaded_at", "updated_at", "removed_at",
        )

    @property
    def pos(self) -> DataFrame:
        """Objects that have a place."""
        return self.obj.dropna(subset=["ra", "dec"])

    @property
    def ep(self) -> DataFrame:
        return self.epochs(self.table("matched_epoch"), "snr", "flags")

    def epochs(self, rows: DataFrame, *rest: str) -> DataFrame:
        """Of repeated rows of epochs the last loaded, where its flux is good; ``rest`` of the columns snr and flags, which do not decide it."""
        key = ["night_id", "star_id", "frame_index", "aper"]
        more = {"snr": F.col("snr").cast("double").alias("snr"), "flags": F.col("flags")}
        last = rows.groupBy(*key).agg(F.max(F.struct("loaded_at", F.when(~F.isnan("flux"), F.col("flux")).alias("flux"), "fluxerr", *(more[x] for x in rest))).alias("r"))
        good = "flux > 0 and flux < double('infinity') and fluxerr > 0 and fluxerr < double('infinity')"
        return last.select(*key, "r.flux", "r.fluxerr", *(f"r.{x}" for x in rest)).filter(good)

    @property
    def det(self) -> DataFrame:
        rest = ["obj_id", "night_id", "mn_run_id", "kind", "flags", "status", "loaded_at", "snr", "depth", "duration_h", "tc_bjd_tdb"]
        last = self.table("detection").groupBy("det_id").agg(F.max_by(F.struct(*rest), "loaded_at").alias("r")).select("det_id", "r.*")
        return last.withColumns({c: clean(F.col(c)) for c in ("snr", "depth", "duration_h", "tc_bjd_tdb")})

    @property
    def shape(self) -> DataFrame:
        keep = ["shape_id", "obj_id", "n_points", "fit_input", "converged", "t14_lower_limit", "computed_at"]
        return self.table("transit_shape").select(*keep, *(clean(F.col(c)).alias(c) for c in ("tc", "tc_err", "depth", "t14_h")))

    @property
    def night(self) -> DataFrame:
        return self.table("night")


def with_inputs(sql: str) -> str:
    """SQL preceded by the named inputs that it uses, and by those that these use."""
    text, used = sql.strip(), []
    for n, q in reversed(INPUTS.items()):
        if any(re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", x) for x in (text, *used)):
            used.append(f"{n} AS ({q})")
    if not used:
        return text
    return f"WITH {', '.join(reversed(used))}" + (", " + text[5:] if text.upper().startswith("WITH ") else " " + text)


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of ``Inputs`` under a name, with its SQL if there is any."""

    def register(f: Callable[[Inputs], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, folder: f(Inputs(spark, folder))
        if sql is not None:
            ORACLE[name] = with_inputs(sql)
        return f

    return register
