"""Distances between places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import haversine
from waybill.operators.joins import spread_join
from waybill.operators.ordered import running_totals
from waybill.operators.staging import staged


def _blocks(sites: DataFrame, site: str, lat: str, lon: str, block: int) -> tuple[DataFrame, Column]:
    """Sites packed into arrays of about ``block``, and the number of arrays."""
    count = sites.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("int")).scalar()
    packed = sites.groupBy(F.pmod(F.xxhash64(site), count).cast("int").alias("_block")).agg(
        F.collect_list(
            F.struct(F.col(site).alias("site"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
        ).alias("_sites")
    )
    return packed, count


def _on_sphere(lat: str, lon: str) -> dict[str, Column]:
    """The place as a point of the unit sphere."""
    a, o = F.radians(lat), F.radians(lon)
    return {"_x": F.cos(a) * F.cos(o), "_y": F.cos(a) * F.sin(o), "_z": F.sin(a)}


def _curve(bits: int = 16) -> Column:
    """Place on a curve that keeps near points of the sphere near: the bits of x, y and z in turn."""
    out = F.lit(0).cast("long")
    for axis, name in enumerate(_AXES):
        whole = F.floor((F.col(name) + 1) * (1 << (bits - 1)))
        for k in range(bits):
            out = out + F.shiftleft(F.shiftright(whole, k).bitwiseAND(F.lit(1)), 3 * k + axis)
    return out


_AXES = ("_x", "_y", "_z")


def _boxes(rows: DataFrame, ident: Column, child: Column, bounds: bool) -> DataFrame:
    """Rows of one level gathered to boxes: children, lowest and highest corner, one place inside."""
    low = [F.min(f"lo{c}" if bounds else c).alias(f"lo{c}") for c in _AXES]
    high = [F.max(f"hi{c}" if bounds else c).alias(f"hi{c}") for c in _AXES]
    inside = [F.first(c).alias(c) for c in _AXES]
    return rows.groupBy(ident.alias("_box")).agg(F.collect_list(child).alias("_children"), *low, *high, *inside)


_BOX = ["_box", *[f"lo{c}" for c in _AXES], *[f"hi{c}" for c in _AXES], *_AXES]


def _square(parts: list[Column]) -> Column:
    return parts[0] * parts[0] + parts[1] * parts[1] + parts[2] * parts[2]


def _near(boxes: Column, bound: Column | None) -> tuple[Column, Column]:
    """The boxes that may hold the nearest site, and the bound on its squared chord.

    Each box holds a site at its known place, so the nearest site is no farther than the nearest of
    these; a box whose nearest corner or face is farther than that holds none of the nearest sites.
    """
    known = F.array_min(F.transform(boxes, lambda b: _square([b[c] - F.col(c) for c in _AXES])))
    bound = known if bound is None else F.least(bound, known)

    def gap(b: Column) -> Column:
        return _square([F.greatest(b[f"lo{c}"] - F.col(c), F.col(c) - b[f"hi{c}"], F.lit(0.0)) for c in _AXES])

    # The outer array of one element has the bound computed once for all boxes.
    kept = F.flatten(F.transform(F.array(bound), lambda u: F.filter(boxes, lambda b: gap(b) <= u * (1 + 1e-9) + 1e-15)))
    return F.transform(kept, lambda b: b["_box"]), bound


def nearest(
    points: DataFrame,
    sites: DataFrame,
    point_id: str,
    site: str,
    lat: str = "lat",
    lon: str = "lon",
    block: int = 2_000,
) -> DataFrame:
    """Nearest site of every point and its distance in kilometres.

    Up to ``block`` sites are one array, and distances are computed and reduced inside a point's row.
    More sites are laid along a curve that keeps neighbours together and cut into boxes of ``block`` / 8,
    boxes into boxes, until so few are left. A point goes down from these: at each level it keeps the
    boxes that can still hold its nearest site, by an exact bound, so it meets a few boxes of sites
    however many there are. Dense places only have smaller boxes; a box that many points ask for is
    spread over tasks.

    Equal distances go to the site that sorts first; of sites at the same place that one is kept.
    Sites without a place are left out; a point without one, or without any site, gets no row. Points
    with the same ``point_id`` are one point at several places.
    """
    here = points.select(F.col(point_id), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    here = here.where(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    known = (
        sites.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        .agg(F.min(site).alias("site"))
    )
    known = staged(known.withColumns(_on_sphere("lat", "lon")))
    count = known.count()

    def best(found: Column) -> Column:
        return F.array_min(
            F.transform(
                found,
                lambda s: F.struct(haversine(F.col("_lat"), F.col("_lon"), s["lat"], s["lon"]).alias("km"), s["site"].alias("site")),
            )
        )

    one = F.struct("site", "lat", "lon")
    if count <= block:
        array = known.agg(F.collect_list(one)).scalar()
        local = here.withColumn("_sites", array).select(point_id, best(F.col("_sites")).alias("_best")).where("_best IS NOT NULL")
    else:
        size = max(2, block // 8)
        order = ["_curve", "lat", "lon"]
        ranked = running_totals(known.withColumn("_curve", _curve()), [], order, {"_rank": F.lit(1).cast("long")})
        box = lambda c: F.floor((F.col(c) - 1) / size).cast("long")
        levels = [staged(_boxes(ranked, box("_rank"), one, False))]
        left = -(-count // size)
        while left > block:
            upper = F.floor(F.col("_box") / size).cast("long")
            levels.append(staged(_boxes(levels[-1], upper, F.struct(*_BOX), True)))
            left = -(-left // size)
        top = levels[-1].agg(F.collect_list(F.struct(*_BOX))).scalar()
        state = here.withColumns(_on_sphere("_lat", "_lon")).withColumn("_top", top)
        ids, bound = _near(F.col("_top"), None)
        state = state.withColumn("_boxes", ids).withColumn("_bound", bound).drop("_top")
        for depth in range(len(levels) - 1, -1, -1):
            asked = state.withColumn("_box", F.explode("_boxes")).drop("_boxes")
            met = spread_join(asked, levels[depth].select("_box", "_children"), ["_box"], [point_id, "_lat", "_lon"])
            if depth:
                ids, bound = _near(F.col("_children"), F.col("_bound"))
                state = met.withColumn("_boxes", ids).withColumn("_bound", bound).drop("_box", "_children")
        local = met.select(point_id, best(F.col("_children")).alias("_best"))
    return (
        local.groupBy(point_id)
        .agg(F.min("_best").alias("_best"))
        .select(point_id, F.col("_best.site").alias("nearest_site"), F.col("_best.km").alias("km"))
    )


def distance_matrix(
    sites: DataFrame, site: str, lat: str = "lat", lon: str = "lon", block: int = 2_000
) -> DataFrame:
    """Distance of every ordered pair of different sites, in long form."""
    packed, count = _blocks(sites, site, lat, lon, block)
    spread = sites.select(site, lat, lon).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), count - 1))
    )
    pairs = spread.join(packed, "_block").select(
        F.col(site).alias("site_a"), lat, lon, F.explode("_sites").alias("_s")
    )
    return pairs.where(F.col("site_a") != F.col("_s.site")).select(
        "site_a",
        F.col("_s.site").alias("site_b"),
        haversine(F.col(lat), F.col(lon), F.col("_s.lat"), F.col("_s.lon")).alias("km"),
    )
