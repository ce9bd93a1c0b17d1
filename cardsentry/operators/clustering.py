"""Online leader clustering (A5), main cluster (A6) and the rest (A7).

Per group (user, day) and in arrival order, a point joins the *first-created*
cluster whose centre is less than 100 km away, and that centre moves to the
running mean of its members; otherwise the point opens a new cluster.  The
largest cluster is the main one (ties: first created); every point of another
cluster is a suspect.

The fold is order dependent, but only among points that are near each other:
``far_parts`` cuts a group at gaps of over 100 km in latitude or longitude into
parts whose folds cannot touch, so the unit of sequential work is a part.  A part
whose box is under 100 km across is one cluster and needs no fold at all.  The
others run as one streaming pass: Spark hash-partitions on (group, part) and
sorts each partition by (group, part, ts, seq) (external sort, spills), then
``mapInPandas`` walks the Arrow batches keeping only the centres of the *current*
part (O(#clusters) memory, never its rows).  Each row leaves with the number of
its cluster (1 = first created), the cluster's size after it joined (``run_n``)
and the centre after the row joined.  Clusters of a group's parts are numbered
together by their first row, from one small row per cluster (``label_clusters``).
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import epoch_micros
from ..tables import stash
from .nearest import arrival_window
from .skew import join_stats
from ..schema import EARTH_RADIUS_KM, MAX_CENTRE_DISTANCE_KM

ORDER = ["ts", "seq"]
CELL_DEGREES = 0.25
NO_CELL = -1_000_000

# Ship this module's fold helpers with the task by value, so executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def haversine_py(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Scalar twin of ``functions.geo.haversine_km`` for the fold."""
    dlat = math.radians(lat2 - lat1)
    dlon = math.radians(lon2 - lon1)
    a = (math.sin(dlat / 2) ** 2
         + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dlon / 2) ** 2)
    a = min(a, 1.0)
    return EARTH_RADIUS_KM * (2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)))


def _fold_batches(batches, max_km: float, update_centre: bool):
    """Leader clustering over batches sorted by (_g1, _g2, _g3, ts, seq).

    Same arithmetic, in the same order, as ``haversine_py``; the centre's
    cosine is cached per cluster and the point's computed once per row.
    """
    import numpy as np
    from math import atan2, cos, radians, sin, sqrt

    radius = EARTH_RADIUS_KM
    cur1 = cur2 = cur3 = None
    clat: list[float] = []
    clon: list[float] = []
    ccos: list[float] = []
    cn: list[int] = []
    for pdf in batches:
        g1 = pdf["_g1"].tolist()
        g2 = pdf["_g2"].tolist()
        g3 = pdf["_g3"].tolist()
        lat = pdf["lat"].astype("float64").tolist()
        lon = pdf["lon"].astype("float64").tolist()
        n = len(lat)
        cid = [0] * n
        run_n = [0] * n
        c_lat = [0.0] * n
        c_lon = [0.0] * n
        for i in range(n):
            if g1[i] != cur1 or g2[i] != cur2 or g3[i] != cur3:
                cur1, cur2, cur3 = g1[i], g2[i], g3[i]
                clat, clon, ccos, cn = [], [], [], []
            la = lat[i]
            lo = lon[i]
            cos_la = cos(radians(la))
            hit = -1
            for j in range(len(clat)):
                a = sin(radians(la - clat[j]) / 2) ** 2 + ccos[j] * cos_la * sin(radians(lo - clon[j]) / 2) ** 2
                if a > 1.0:
                    a = 1.0
                if radius * (2 * atan2(sqrt(a), sqrt(1 - a))) < max_km:
                    hit = j
                    break
            if hit < 0:
                clat.append(la)
                clon.append(lo)
                ccos.append(cos_la)
                cn.append(1)
                cid[i] = len(clat)
                run_n[i] = 1
                c_lat[i], c_lon[i] = la, lo
            else:
                m = cn[hit]
                if update_centre:
                    clat[hit] = (clat[hit] * m + la) / (m + 1)
                    clon[hit] = (clon[hit] * m + lo) / (m + 1)
                    ccos[hit] = cos(radians(clat[hit]))
                cn[hit] = m + 1
                cid[i] = hit + 1
                run_n[i] = m + 1
                c_lat[i], c_lon[i] = clat[hit], clon[hit]
        yield pdf.drop(columns=["_g1", "_g2", "_g3"]).assign(
            cid=np.asarray(cid, dtype=np.int32), run_n=np.asarray(run_n, dtype=np.int32),
            centre_lat=np.asarray(c_lat, dtype=np.float64), centre_lon=np.asarray(c_lon, dtype=np.float64))


def leader_clusters(df: DataFrame, group_cols: list[str], max_km: float = MAX_CENTRE_DISTANCE_KM,
                    update_centre: bool = True, part: str | None = None) -> DataFrame:
    """Add ``cid`` and ``run_n`` to every row (see module doc).

    ``group_cols`` is ``[key, window_start, window_end]``; ``update_centre=False``
    keeps each centre at its first point (the fixed-centre draft variant); with
    ``part`` (a long column) the parts of a group are folded apart.
    """
    key, wstart = group_cols[0], group_cols[1]
    # DECIMAL columns cross the Python boundary as their exact unscaled
    # integers (pandas would otherwise build one Decimal object per value).
    decimals = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    for name, dt in decimals.items():
        df = df.withColumn(name, (F.col(name) * F.lit(10 ** dt.scale)).cast("long")
                           if dt.precision <= 18 else F.col(name).cast("string"))
    # The fold needs every group whole in one task.  Partitioning on a derived
    # column keeps the optimizer from dropping this exchange in favour of one
    # below it that adaptive execution may split.
    src = (df.withColumn("_g1", F.col(key).cast("long"))
           .withColumn("_g2", epoch_micros(wstart))
           .withColumn("_g3", F.col(part) if part else F.lit(0).cast("long"))
           .withColumn("_part", F.xxhash64("_g1", "_g2", "_g3"))
           .repartition("_part")
           .sortWithinPartitions("_g1", "_g2", "_g3", *ORDER, "lat", "lon").drop("_part"))
    out_schema = T.StructType([f for f in src.schema.fields if f.name not in ("_g1", "_g2", "_g3")]
                              + [T.StructField("cid", T.IntegerType()),
                                 T.StructField("run_n", T.IntegerType()),
                                 T.StructField("centre_lat", T.DoubleType()),
                                 T.StructField("centre_lon", T.DoubleType())])
    out = src.mapInPandas(lambda it: _fold_batches(it, max_km, update_centre), out_schema)
    for name, dt in decimals.items():
        out = out.withColumn(name, (F.col(name).cast(T.DecimalType(38, dt.scale))
                                    / F.lit(10 ** dt.scale)).cast(dt)
                             if dt.precision <= 18 else F.col(name).cast(dt))
    return out


def leader_clusters_skipping_single(df: DataFrame, group_cols: list[str],
                                    max_km: float = MAX_CENTRE_DISTANCE_KM) -> DataFrame:
    """``leader_clusters`` for detection: groups that provably form one
    cluster (``single_cluster_groups``) bypass the fold and get ``cid = 1``
    (their ``run_n`` and centres are left NULL: detection needs neither)."""
    flags = single_cluster_groups(df, group_cols, max_km)
    tagged = df.join(flags, group_cols)
    multi = leader_clusters(tagged.where(~F.col("single")).drop("single"), group_cols, max_km)
    single = (tagged.where(F.col("single")).drop("single")
              .withColumn("cid", F.lit(1))
              .withColumn("run_n", F.lit(None).cast("int"))
              .withColumn("centre_lat", F.lit(None).cast("double"))
              .withColumn("centre_lon", F.lit(None).cast("double")))
    return multi.unionByName(single)


def _cut(cells: DataFrame, group_cols: list[str], axis: str, turn: int, km: float) -> DataFrame:
    """Split every part where its cells leave a gap wider than ``km`` along one axis."""
    cell, low, high = f"_{axis}_cell", f"_{axis}0", f"_{axis}1"
    part = Window.partitionBy(*group_cols, "part")
    along = part.orderBy(cell)
    marks = [F.max(high).over(along.rangeBetween(Window.unboundedPreceding, -1)).alias("_before"),
             F.min(low).over(along.rangeBetween(0, 0)).alias("_here")]
    gap = F.radians(F.col("_here") - F.col("_before"))
    if axis == "lat":
        apart = F.lit(EARTH_RADIUS_KM) * gap > F.lit(km)
    else:
        # sin(d / 2R) >= cos(lat) * sin(dlon / 2), which is least at the ends of [gap, span]
        marks += [F.min(F.least(F.cos(F.radians("_lat0")), F.cos(F.radians("_lat1")))).over(part).alias("_cos"),
                  (F.max(high).over(part) - F.min(low).over(part)).alias("_span")]
        far = F.lit(math.sin(km / (2 * EARTH_RADIUS_KM)))
        apart = ((F.col("_span") < 360) & (F.col("_cos") * F.sin(gap / 2) > far)
                 & (F.col("_cos") * F.sin(F.radians("_span") / 2) > far))
    band = F.max(F.when(apart, F.col(cell))).over(along.rangeBetween(Window.unboundedPreceding, 0))
    named = F.xxhash64("part", F.lit(turn), F.coalesce(band, F.lit(NO_CELL).cast("long"))).alias("part")
    return cells.select("*", *marks).select(*[named if c == "part" else c for c in cells.columns])


def with_cells(df: DataFrame) -> DataFrame:
    """Add the grid cell of every row; rows without a position share one of their own."""
    for axis in ("lat", "lon"):
        cell = F.when(~F.isnan(axis), F.floor(F.col(axis) / F.lit(CELL_DEGREES)).cast("long"))
        df = df.withColumn(f"_{axis}_cell", F.coalesce(cell, F.lit(NO_CELL).cast("long")))
    return df


def far_parts(df: DataFrame, group_cols: list[str], max_km: float = MAX_CENTRE_DISTANCE_KM,
              margin_km: float = 1.0) -> DataFrame:
    """Parts of every group that leader clustering treats independently.

    One row per grid cell of a group: ``part``, ``single`` (the part provably
    folds into one cluster), ``many`` (the group may hold several clusters) and the
    group's row count and first and last instant (``_rows``, ``_t0``, ``_t1``).

    A running centre is a mean of points, so it stays in its part's box.  A cut
    at a gap in latitude, or in longitude within the part's latitudes, keeps the
    two boxes over ``max_km`` apart: no point ever sees a centre of another part.
    Longitudes are only cut where the way around the globe is far too (they are
    averaged as plain numbers, and may leave +-180).  ``margin_km`` absorbs
    floating-point error.

    Rows are reduced to cells first (a partial aggregate); the windows run over a
    group's occupied cells, which the globe bounds, never over its rows.
    """
    r = EARTH_RADIUS_KM
    lat, lon = (F.when(~F.isnan(c), F.col(c)) for c in ("lat", "lon"))
    t = epoch_micros("ts")
    keys = [*group_cols, "_lat_cell", "_lon_cell"]
    cells = (with_cells(df).groupBy(*keys)
             .agg(F.min(lat).alias("_lat0"), F.max(lat).alias("_lat1"), F.min(lon).alias("_lon0"), F.max(lon).alias("_lon1"),
                  F.count_if(lat.isNull() | lon.isNull()).alias("_lost"), F.count(F.lit(1)).alias("_n"),
                  F.min(t).alias("_first"), F.max(t).alias("_last"))
             .withColumn("part", F.lit(0).cast("long")))
    for turn, axis in enumerate(("lat", "lon", "lat")):
        cells = _cut(cells, group_cols, axis, turn, max_km + margin_km)
    part, group = Window.partitionBy(*group_cols, "part"), Window.partitionBy(*group_cols)
    cells = cells.select(
        *keys, "part", F.min("_lat0").over(part).alias("_s"), F.max("_lat1").over(part).alias("_n"),
        F.min("_lon0").over(part).alias("_w"), F.max("_lon1").over(part).alias("_e"), F.sum("_lost").over(part).alias("_none"),
        F.sum("_n").over(group).alias("_rows"), F.min("_first").over(group).alias("_t0"), F.max("_last").over(group).alias("_t1"))
    widest = (F.when((F.col("_s") <= 0) & (F.col("_n") >= 0), F.lit(1.0))
              .otherwise(F.greatest(F.cos(F.radians("_s")), F.cos(F.radians("_n")))))
    bound = F.lit(r) * F.radians(F.col("_n") - F.col("_s")) + F.lit(r) * widest * F.radians(F.col("_e") - F.col("_w"))
    single = F.coalesce((bound < F.lit(max_km - margin_km)) & (F.col("_e") - F.col("_w") < 90) & (F.col("_none") == 0), F.lit(False))
    many = ~F.min(single).over(group) | (F.min("part").over(group) != F.max("part").over(group))
    return cells.select(*keys, "part", single.alias("single"), many.alias("many"), "_rows", "_t0", "_t1")


def label_clusters(rows: DataFrame, group_cols: list[str]) -> DataFrame:
    """Number the clusters of a group's parts together and find its main cluster.

    ``rows`` (a written table) have ``part`` and the number of their cluster in it;
    ``cid`` becomes the number in the group by first (ts, seq), and ``main_cid``,
    ``main_n``, ``n_clusters`` and ``is_main`` are added.  Windows run over one row
    per cluster; rows are only joined with them, dealt over several tasks.
    """
    keys = [*group_cols, "part", "cid"]
    clusters = rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("_n"), F.min(F.struct(*ORDER, "lat", "lon")).alias("_at"))
    group = Window.partitionBy(*group_cols)
    number = F.row_number().over(group.orderBy("_at.ts", "_at.seq", "_at.lat", "_at.lon", "part", "cid"))
    named = clusters.select(*keys, "_n", number.alias("_cid"), F.count(F.lit(1)).over(group).cast("int").alias("n_clusters"))
    best = F.max(F.struct(F.col("_n").alias("n"), (-F.col("_cid")).alias("neg"))).over(group)
    named = named.select(*keys, "_cid", "n_clusters", best.alias("_best"))
    kept = [c for c in rows.columns if c not in ("part", "cid")]
    return join_stats(rows, named, keys).select(
        *kept, F.col("_cid").alias("cid"), (-F.col("_best.neg")).alias("main_cid"), F.col("_best.n").alias("main_n"), "n_clusters",
        (F.col("_cid") == -F.col("_best.neg")).alias("is_main"))


def clusters_by_part(df: DataFrame, group_cols: list[str], max_km: float = MAX_CENTRE_DISTANCE_KM,
                     update_centre: bool = True, suspects_only: bool = False,
                     large_group: int | None = None) -> DataFrame:
    """Rows with their cluster and the group's main cluster (see ``label_clusters``), each part folded apart.

    ``suspects_only`` leaves out groups that provably have one cluster, and the
    fold of parts that provably are one (``run_n`` and the centres are NULL there).
    The folded rows are written to the shared folder: the fold runs once.  Where a
    group has over ``large_group`` rows, the groups' ``_rows``, ``_t0`` and ``_t1``
    are kept for the scans that cut it.
    """
    parts = far_parts(df, group_cols, max_km)
    if suspects_only:
        parts = parts.where("many")
    rows = join_stats(with_cells(df), parts.drop("many"), [*group_cols, "_lat_cell", "_lon_cell"]).drop("_lat_cell", "_lon_cell")
    if suspects_only:
        whole = (rows.where("single").withColumn("cid", F.lit(1)).withColumn("run_n", F.lit(None).cast("int"))
                 .withColumn("centre_lat", F.lit(None).cast("double")).withColumn("centre_lon", F.lit(None).cast("double")))
        folded = leader_clusters(rows.where(~F.col("single")), group_cols, max_km, update_centre, "part").unionByName(whole)
    else:
        folded = leader_clusters(rows, group_cols, max_km, update_centre, "part")
    written = stash(folded.drop("single"), "clusters")
    if large_group is None or not written.where(F.col("_rows") > large_group).limit(1).count():
        written = written.drop("_rows", "_t0", "_t1")
    return label_clusters(written, group_cols)


def with_main_cluster(clustered: DataFrame, group_cols: list[str]) -> DataFrame:
    """Add ``main_cid``, ``main_n`` and ``n_clusters`` per group; ``is_main`` per row.

    ``max(struct(run_n, -cid))`` over the group is the largest final size with
    the first-created cluster winning ties.
    """
    # Whole-group frame on the arrival-order spec: shares the sort of the
    # arrival-order scans that follow (an unbounded frame is O(n)).
    whole = arrival_window(group_cols).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = F.max(F.struct(F.col("run_n").alias("n"), (-F.col("cid")).alias("neg_cid"))).over(whole)
    return (clustered
            .withColumn("_best", best)
            .withColumn("n_clusters", F.max("cid").over(whole))
            .withColumn("main_cid", -F.col("_best.neg_cid"))
            .withColumn("main_n", F.col("_best.n"))
            .withColumn("is_main", F.col("cid") == F.col("main_cid"))
            .drop("_best"))


def one_cluster_box(lat0: Column, lat1: Column, lon0: Column, lon1: Column,
                    max_km: float = MAX_CENTRE_DISTANCE_KM, margin_km: float = 1.0) -> Column:
    """Whether the points of a lat/lon box provably fold into one cluster.

    If every point lies in a lat/lon box whose great-circle diameter is below
    ``max_km``, every running centre (a mean of points in the box) is in the
    box too, so each point is within ``max_km`` of cluster 1 and joins it.
    The diameter is bounded by going along a meridian then a parallel:
    ``R·Δlat + R·cos(lat nearest the equator)·Δlon`` (valid for Δlon < 180°;
    90° is required).  ``margin_km`` absorbs floating-point error.
    """
    r = EARTH_RADIUS_KM
    cos_max = (F.when((lat0 <= 0) & (lat1 >= 0), F.lit(1.0))
               .otherwise(F.greatest(F.cos(F.radians(lat0)), F.cos(F.radians(lat1)))))
    bound = F.lit(r) * F.radians(lat1 - lat0) + F.lit(r) * cos_max * F.radians(lon1 - lon0)
    single = (bound < F.lit(max_km - margin_km)) & ((lon1 - lon0) < F.lit(90.0))
    return F.coalesce(single, F.lit(False))


def single_cluster_groups(df: DataFrame, group_cols: list[str], max_km: float = MAX_CENTRE_DISTANCE_KM,
                          margin_km: float = 1.0) -> DataFrame:
    """Per group: ``single`` = the fold provably yields one cluster (``one_cluster_box``).

    The box is a partial aggregate, so a hot group costs one small row per map task.
    """
    box = df.groupBy(*group_cols).agg(F.min("lat").alias("_lat0"), F.max("lat").alias("_lat1"),
                                      F.min("lon").alias("_lon0"), F.max("lon").alias("_lon1"))
    corners = (F.col(c) for c in ("_lat0", "_lat1", "_lon0", "_lon1"))
    return box.select(*group_cols, one_cluster_box(*corners, max_km, margin_km).alias("single"))


def cluster_summary(clustered: DataFrame, group_cols: list[str]) -> DataFrame:
    """One row per cluster: size, creation number and final centre.

    The final centre is the centre recorded at the member with the largest
    ``run_n``: a partial aggregate, no member list is ever built."""
    last = F.struct("run_n", "centre_lat", "centre_lon")
    return (clustered.groupBy(*group_cols, "cid")
            .agg(F.max(last).alias("_last"))
            .select(*group_cols, "cid", F.col("_last.run_n").alias("n"),
                    F.col("_last.centre_lat").alias("centre_lat"),
                    F.col("_last.centre_lon").alias("centre_lon")))
