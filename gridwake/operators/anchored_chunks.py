"""Anchored rule for the post-outlier stretch of tracks, split into time chunks.

The anchored rule is sequential: whether a row is accepted depends on the
anchor left by all earlier rows. Rows are cut into ``(id, chunk)`` pieces, and
each piece is a *transfer map*: from the anchor it is entered with to the
anchor it is left with (or to the end of the track, once a row comes too
late). Maps are evaluated where they are needed and then composed:

1. *Explore.* Every chunk is scanned from the last row of the id's previous
   chunk (the first chunk: from its own first row, which is exact). Each exit
   found is an entry of a later chunk, and so is, to begin with, every row
   among a chunk's last ones that ends a chain of rows in reach of each other
   (one per track interleaved under the id). Entries a chunk was not scanned
   with yet are scanned in the next round, all chunks at once. Chains that
   meet share their exits, so the maps close after a few rounds; the loop ends
   when no new (chunk, entry) pair appears. What is tried first decides the
   number of rounds, never the result, and every scan handles one chunk's
   rows, whatever the shape of the tracks.
2. *Jump.* An exit does not simply enter the next chunk: the first scan
   leaves a summary of each chunk, a few caps (centre and radius) that hold
   all its rows, and its last time. An anchor passes unchanged through chunks
   whose caps are all out of its reach and which end within its time limit, so
   the exit enters the first chunk for which that does not hold, however many
   lie between. Summaries form a tree (``FAN`` chunks a node, nodes summarised
   alike), so the search is a few equi-joins for any number of chunks.
3. *Compose.* The pairs that the real track passes are those reachable from
   each id's first chunk. Pointer doubling finds them in log2(chunks)
   equi-joins over the map table (a few rows per chunk).
4. Segments scanned from reachable pairs are the result.

The scan follows a chunk in numpy: runs of rows that stay in reach of their
predecessor are accepted at once, and only where a row is out of reach are
later rows searched, in blocks. Distances in the output are computed by the
column expressions all operators share.

Scans and maps are written as Parquet to the intermediate folder, so lineage
stays short and lost executors recompute only the current round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import elapsed_seconds, great_circle_km, haversine_km, speed_kmh
from ..session import intermediate, release

SCAN_DDL = ("kind int, id string, chunk bigint, entered boolean, ets bigint, elat double, elon double, "
            "ats bigint, alat double, alon double, bts bigint, blat double, blon double")
_KEY = ["id", "chunk", "entered", "ets", "elat", "elon"]
SEARCH_BLOCK = 32
END_ROWS = 2048           # last rows of a chunk in which ends of chains are looked for
CAPS = 16                 # caps that summarise a chunk or a node
FAN = 1024                # chunks or nodes summarised by one node
SLACK_KM = 0.01           # what rounding may add to the sum of two distances


def follow(ts: np.ndarray, lat: np.ndarray, lon: np.ndarray, time_limit: float, dist_limit: float,
           inclusive: bool) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Follow the anchored rule from row 0: (starts, ends) of accepted steps
    as row numbers, the last anchor's row number, and whether the track ended."""
    n = len(ts)

    def late(t):
        return t > time_limit if inclusive else t >= time_limit

    def far(d):
        with np.errstate(invalid="ignore"):
            return d > dist_limit if inclusive else d >= dist_limit      # NaN is never far

    late_step = late(np.diff(ts).astype(float))
    stops = np.flatnonzero(late_step | far(great_circle_km(lat[:-1], lon[:-1], lat[1:], lon[1:])))
    starts, ends, at = [], [], 0
    while True:
        k = int(np.searchsorted(stops, at))
        stop = int(stops[k]) if k < len(stops) else n - 1
        starts.append(np.arange(at, stop))
        ends.append(np.arange(at + 1, stop + 1))
        at = stop
        if k == len(stops):
            return np.concatenate(starts), np.concatenate(ends), at, False
        if late_step[at]:
            return np.concatenate(starts), np.concatenate(ends), at, True
        # the next row is out of reach: look for the first later one in reach
        lo, size, found = at + 2, SEARCH_BLOCK, None
        while lo < n and found is None:
            hi = min(lo + size, n)
            too_late = late((ts[lo:hi] - ts[at]).astype(float))
            near = ~far(great_circle_km(lat[at], lon[at], lat[lo:hi], lon[lo:hi]))
            hit = np.flatnonzero(too_late | near)
            if len(hit):
                found = lo + int(hit[0])
                if too_late[hit[0]]:
                    return np.concatenate(starts), np.concatenate(ends), at, True
            lo, size = hi, size * 2
        if found is None:
            return np.concatenate(starts), np.concatenate(ends), at, False
        starts.append(np.array([at]))
        ends.append(np.array([found]))
        at = found


def chain_ends(lat: np.ndarray, lon: np.ndarray, dist_limit: float) -> list[int]:
    """Rows that have an earlier row in reach but no later one: the ends of
    chains, one per track that passes here. Rows near an end are skipped."""
    left, ends = np.ones(len(lat), dtype=bool), []
    while left.any():
        i = int(np.flatnonzero(left)[-1])
        near = great_circle_km(lat[i], lon[i], lat, lon) <= dist_limit
        if near[:i].any() and not near[i + 1:].any():
            ends.append(i)
        left &= ~near
        left[i] = False
    return ends


class Caps:
    """At most ``CAPS`` circles on the sphere that hold all points added."""

    def __init__(self, radius: float):
        self.radius, self.caps = radius, []

    def add(self, lat: np.ndarray, lon: np.ndarray, own: np.ndarray | None = None) -> None:
        """``own``: radius of each thing added, 0 for points. New caps are
        opened for what lies further than ``radius`` from all centres; the last
        one takes whatever is left over. NaN coordinates are near everything."""
        own = np.zeros(len(lat)) if own is None else own
        if np.isnan(lat + lon).any() or np.isinf(own).any():
            self.caps = [[0.0, 0.0, np.inf]]
        if self.caps and self.caps[0][2] == np.inf:
            return
        left = np.ones(len(lat), dtype=bool)
        for cap in self.caps:
            left &= ~self._take(cap, lat, lon, own, left, self.radius)
        while left.any():
            if len(self.caps) < CAPS:
                i = int(np.argmax(left))
                self.caps.append([float(lat[i]), float(lon[i]), float(own[i])])
                left[i] = False
                left &= ~self._take(self.caps[-1], lat, lon, own, left, self.radius)
            else:
                left &= ~self._take(self.caps[-1], lat, lon, own, left, np.inf)

    @staticmethod
    def _take(cap, lat, lon, own, left, radius) -> np.ndarray:
        """Let ``cap`` hold what lies within ``radius`` of its centre."""
        away = great_circle_km(cap[0], cap[1], lat, lon) + own
        here = left & (away <= radius)
        cap[2] = max(cap[2], float(away[here].max(initial=0.0)))
        return here


def key_groups(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """``(key, first row, last row + 1)`` of the runs of equal keys; a NaN in
    a key equals itself."""
    if not batch.num_rows:
        return
    change = np.zeros(batch.num_rows, dtype=bool)
    change[0] = True
    for c in columns:
        code = pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    starts = np.flatnonzero(change)
    keys = zip(*(batch.column(c).take(pa.array(starts)).to_pylist() for c in columns))
    cuts = [*starts.tolist(), batch.num_rows]
    for key, lo, hi in zip(keys, cuts[:-1], cuts[1:]):
        yield tuple("NaN" if isinstance(v, float) and v != v else v for v in key), lo, hi


def _plain(key: tuple) -> tuple:
    return tuple(float("nan") if v == "NaN" and i else v for i, v in enumerate(key))


def chunk_scanner(time_limit: float, dist_limit: float, inclusive: bool, first: bool):
    """``mapInArrow`` function over rows sorted by (chunk key, dt, lat, lon).

    Emits the moved steps (kind 0) and, unless the track ends in it, one exit
    per chunk and entry (kind 1, the anchor in ``ats, alat, alon``). The
    ``first`` scan also emits the ends of chains among each chunk's last rows
    (kind 2) and the chunk's caps (kind 3: last time, centre, and the radius
    in ``blat``). A chunk may stretch over batches: only its anchor, caps and
    last rows are carried."""

    def emitted(parts):
        """One batch of all ``(key, kind, a, b)``, which are short."""
        sizes = [len(a[0]) for _, _, a, _ in parts]
        of = pa.array(np.repeat(np.arange(len(parts)), sizes))
        without = np.repeat([b is None for *_, b in parts], sizes)
        out = [pa.array([kind for _, kind, _, _ in parts], pa.int32()).take(of)]
        for values, field in zip(zip(*(_plain(p[0]) for p in parts)), ("string", "int64", "bool_", "int64", "float64", "float64")):
            out.append(pa.array(values, getattr(pa, field)()).take(of))
        for side, blank in ((2, None), (3, without)):
            for i, kind in enumerate((np.int64, np.float64, np.float64)):
                pieces = [np.zeros(n, kind) if p[side] is None else np.asarray(p[side][i], kind) for p, n in zip(parts, sizes)]
                out.append(pa.array(np.concatenate(pieces), mask=blank))
        return pa.record_batch(out, names=[part.split()[0] for part in SCAN_DDL.split(", ")])

    def close(key, anchor, ended, tail, caps):
        if not ended:
            yield key, 1, [[v] for v in anchor], None
        if first:
            at = chain_ends(tail[1], tail[2], dist_limit)
            if at:
                yield key, 2, [c[at] for c in tail], None
            n = len(caps.caps)
            lat, lon, radius = zip(*caps.caps)
            yield key, 3, [[int(tail[0][-1])] * n, lat, lon], [[0] * n, radius, [0.0] * n]

    def scan(batches):
        key, anchor, ended, tail, caps, parts = None, None, False, None, None, []
        for batch in batches:
            ts, lat, lon = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ts", "lat", "lon"))
            for now, lo, hi in key_groups(batch, _KEY):
                if now != key:
                    if key is not None:
                        parts.extend(close(key, anchor, ended, tail, caps))
                    key, ended, tail, caps = now, False, None, Caps(dist_limit)
                    anchor = _plain(key)[3:] if key[2] else None
                row = [ts[lo:hi], lat[lo:hi], lon[lo:hi]]
                if first:
                    kept = [c[:0] for c in row] if tail is None else tail
                    tail = [np.concatenate([t, c])[-END_ROWS:] for t, c in zip(kept, row)]
                    caps.add(row[1], row[2])
                if ended:
                    continue
                if anchor is not None:
                    row = [np.concatenate([np.array([v], dtype=c.dtype), c]) for v, c in zip(anchor, row)]
                a, b, last, ended = follow(*row, time_limit, dist_limit, inclusive)
                moved = np.abs(row[1][a] - row[1][b]) + np.abs(row[2][a] - row[2][b]) > 0
                a, b = a[moved], b[moved]
                if len(a):
                    parts.append((key, 0, [c[a] for c in row], [c[b] for c in row]))
                anchor = (int(row[0][last]), float(row[1][last]), float(row[2][last]))
            if parts:
                yield emitted(parts)
                parts = []
        if key is not None:
            parts.extend(close(key, anchor, ended, tail, caps))
        if parts:
            yield emitted(parts)
    return scan


# ---------------------------------------------------------------- summaries

_NODE = "kind int, origin bigint, entered boolean, ets bigint, elat double, elon double"
NODE_DDL = ("id string, level int, block bigint, query boolean, place bigint, chunk bigint, ts bigint, "
            f"lat double, lon double, radius double, {_NODE}")
_ASKED = ["id", "level", "block", "place", "ts", "lat", "lon", "kind", "origin", "entered", "ets", "elat", "elon"]
ANSWER_DDL = ("id string, level int, block bigint, place bigint, ts bigint, lat double, lon double, "
              f"{_NODE}, hit bigint, hit_chunk bigint")


def _merge_caps(dist_limit: float):
    """Rows sorted by node and place -> the node's caps and last time."""
    def flush(key, caps, last, chunk):
        n = len(caps.caps)
        lat, lon, radius = zip(*caps.caps)
        return pa.record_batch([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
                                pa.array([chunk] * n, pa.int64()), pa.array([last] * n, pa.int64()),
                                pa.array(lat, pa.float64()), pa.array(lon, pa.float64()), pa.array(radius, pa.float64())],
                               names=["id", "place", "chunk", "ts", "lat", "lon", "radius"])

    def run(batches):
        key, caps, last, chunk = None, None, None, None
        for batch in batches:
            ts, lat, lon, radius = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ts", "lat", "lon", "radius"))
            for now, lo, hi in key_groups(batch, ["id", "block"]):
                if now != key:
                    if key is not None:
                        yield flush(key, caps, last, chunk)
                    key, caps, last, chunk = now, Caps(4 * dist_limit), int(ts[lo]), batch.column("chunk")[lo].as_py()
                caps.add(lat[lo:hi], lon[lo:hi], radius[lo:hi])
                last = max(last, int(ts[lo:hi].max()))
        if key is not None:
            yield flush(key, caps, last, chunk)
    return run


def _summaries(caps: DataFrame, dist_limit: float) -> tuple[DataFrame, int]:
    """The tree over the chunks' caps (``id, place, chunk, ts, lat, lon,
    radius``): all nodes with ``level``, and the top level."""
    levels = [caps]
    while True:
        widest = levels[-1].agg(F.max("place")).first()[0] or 0
        if widest < FAN:
            break
        levels.append(intermediate(
            levels[-1].withColumn("block", F.floor(F.col("place") / FAN)).repartition("id", "block")
            .sortWithinPartitions("id", "block", "place")
            .mapInArrow(_merge_caps(dist_limit), "id string, place bigint, chunk bigint, ts bigint, lat double, "
                                                 "lon double, radius double"), "anchored-nodes"))
    out = None
    for level, nodes in enumerate(levels):
        nodes = nodes.withColumn("level", F.lit(level))
        out = nodes if out is None else out.unionByName(nodes)
    return out.withColumn("block", F.floor(F.col("place") / FAN)), len(levels) - 1


def first_in_reach(time_limit: float, dist_limit: float, inclusive: bool):
    """``mapInArrow`` function over a node's summaries followed by queries:
    the first place at or after the query's that its anchor may not pass
    unchanged (``hit``, null if there is none in the node)."""
    def run(batches):
        key, nodes = None, None
        names = [part.split()[0] for part in NODE_DDL.split(", ")]
        for batch in batches:
            asked = batch.column("query").to_numpy(zero_copy_only=False)
            value = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names[4:10] if c != "chunk"}
            for now, lo, hi in key_groups(batch, ["id", "level", "block"]):
                if now != key:
                    key, nodes = now, None
                split = lo + int(np.searchsorted(asked[lo:hi], True))
                if split > lo:
                    more = [value[c][lo:split] for c in ("place", "ts", "lat", "lon", "radius")]
                    more.append(batch.column("chunk").slice(lo, split - lo).to_numpy(zero_copy_only=False))
                    nodes = more if nodes is None else [np.concatenate(p) for p in zip(nodes, more)]
                if split == hi:
                    continue
                hit, chunk = [], []
                for i in range(split, hi):
                    found = None
                    if nodes is not None:
                        at, size = int(np.searchsorted(nodes[0], value["place"][i])), SEARCH_BLOCK
                        while at < len(nodes[0]) and found is None:
                            part = slice(at, at + size)
                            since = (nodes[1][part] - value["ts"][i]).astype(float)
                            late = since > time_limit if inclusive else since >= time_limit
                            away = great_circle_km(value["lat"][i], value["lon"][i], nodes[2][part], nodes[3][part])
                            reach = ~(away - nodes[4][part] - SLACK_KM > dist_limit)        # NaN is in reach
                            some = np.flatnonzero(late | reach)
                            found = at + int(some[0]) if len(some) else None
                            at, size = at + size, size * 4
                    hit.append(None if found is None else int(nodes[0][found]))
                    chunk.append(None if found is None else int(nodes[5][found]))
                rows = batch.slice(split, hi - split)
                yield pa.record_batch([*[rows.column(c) for c in _ASKED], pa.array(hit, pa.int64()),
                                       pa.array(chunk, pa.int64())],
                                      names=[*_ASKED, "hit", "hit_chunk"])
    return run


def _jump(exits: DataFrame, nodes: DataFrame, top: int, finder) -> DataFrame:
    """``exits``: anchors (``id, ts, lat, lon``) that look for a chunk from
    ``place`` on, with ``_NODE`` columns carried along. Returns them with
    ``hit_chunk``; those that no later chunk can change are left out."""
    names = [part.split()[0] for part in NODE_DDL.split(", ")]

    def answers(asked: DataFrame) -> DataFrame:
        asked = asked.select("id", "level", F.floor(F.col("place") / FAN).alias("block"), F.lit(True).alias("query"),
                             "place", F.lit(None).cast("bigint").alias("chunk"), "ts", "lat", "lon",
                             F.lit(None).cast("double").alias("radius"),
                             "kind", "origin", "entered", "ets", "elat", "elon")
        all_rows = nodes.withColumn("query", F.lit(False)).unionByName(asked, allowMissingColumns=True)
        return (all_rows.repartition("id", "level", "block")
                .sortWithinPartitions("id", "level", "block", "query", "place").select(*names)
                .mapInArrow(finder, ANSWER_DDL))

    pending, done = exits.withColumn("level", F.lit(0)), None
    while True:
        out = answers(pending)
        if top:
            out = intermediate(out, "anchored-search")
        found = out.where((F.col("level") == 0) & F.col("hit").isNotNull())
        done = found if done is None else done.unionByName(found)
        if not top:
            return done
        down = out.where((F.col("level") > 0) & F.col("hit").isNotNull())
        up = out.where(F.col("hit").isNull() & (F.col("level") < top))
        carried = ["id", "ts", "lat", "lon", "kind", "origin", "entered", "ets", "elat", "elon"]
        pending = (down.select((F.col("level") - 1).alias("level"), (F.col("hit") * FAN).alias("place"), *carried)
                   .unionByName(up.select((F.col("level") + 1).alias("level"), (F.col("block") + 1).alias("place"),
                                          *carried)))
        if pending.isEmpty():
            return done


def _same(columns: list[str], x: str, y: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}"))
    return out


def _reachable(edges: DataFrame, first: DataFrame) -> DataFrame:
    """Nodes reachable from ``first`` (column ``node``) over ``edges``
    (``node, next``, at most one edge per node), by pointer doubling."""
    reached, jump = first, edges
    while True:
        more = intermediate(reached.join(jump, "node").select(F.col("next").alias("node"))
                            .unionByName(reached).distinct(), "anchored-reached")
        jump = intermediate(jump.alias("x").join(jump.alias("y"), F.col("x.next") == F.col("y.node"))
                            .select(F.col("x.node").alias("node"), F.col("y.next").alias("next")), "anchored-jump")
        reached = more
        if jump.isEmpty():
            return reached


def anchored_chunk_segments(rows: DataFrame, time_limit: float, dist_limit: float, inclusive: bool,
                            zero_time_velocity: float) -> DataFrame:
    """Segments of the anchored rule for ``rows`` (``id, chunk, ts, lat, lon,
    _dt``); each id's first row is its anchor. Runs Spark actions (one scan
    per round and a few small joins); the returned frame reads written
    tables."""
    rows = intermediate(rows.select("id", "chunk", "ts", "lat", "lon", "_dt"), "anchored-rows")

    by_id = Window.partitionBy("id").orderBy("chunk")
    last = rows.groupBy("id", "chunk").agg(F.max(F.struct("_dt", "lat", "lon", "ts")).alias("last"))
    chunks = intermediate(last.select("id", "chunk", F.lag("last").over(by_id).alias("before"),
                                      (F.row_number().over(by_id) - 1).cast("bigint").alias("place")), "anchored-chunks")
    entries = chunks.select("id", "chunk", F.col("before").isNotNull().alias("entered"),
                            F.col("before.ts").alias("ets"), F.col("before.lat").alias("elat"),
                            F.col("before.lon").alias("elon"))
    finder = first_in_reach(time_limit, dist_limit, inclusive)
    places = chunks.select("id", "chunk", "place")
    scans, maps, known, nodes, top = [], [], None, None, 0
    while True:
        scanner = chunk_scanner(time_limit, dist_limit, inclusive, first=known is None)
        known = entries if known is None else known.unionByName(entries)
        out = intermediate(rows.join(entries, ["id", "chunk"]).repartition(*_KEY)
                           .sortWithinPartitions(*_KEY, "_dt", "lat", "lon")
                           .select(*_KEY, "ts", "lat", "lon").mapInArrow(scanner, SCAN_DDL), "anchored-scan")
        scans.append(out.where("kind = 0"))
        placed = out.where("kind > 0").join(places, ["id", "chunk"])
        if nodes is None:
            nodes, top = _summaries(placed.where("kind = 3").select(
                "id", "place", "chunk", F.col("ats").alias("ts"), F.col("alat").alias("lat"),
                F.col("alon").alias("lon"), F.col("blat").alias("radius")), dist_limit)
        exits = placed.where("kind < 3").select(
            "id", (F.col("place") + 1).alias("place"), F.col("ats").alias("ts"), F.col("alat").alias("lat"),
            F.col("alon").alias("lon"), "kind", F.col("chunk").alias("origin"), "entered", "ets", "elat", "elon")
        leads = intermediate(
            _jump(exits, nodes, top, finder)
            .select("kind", F.struct("id", F.col("origin").alias("chunk"), "entered", "ets", "elat", "elon").alias("node"),
                    F.struct("id", F.col("hit_chunk").alias("chunk"), F.lit(True).alias("entered"), F.col("ts").alias("ets"),
                             F.col("lat").alias("elat"), F.col("lon").alias("elon")).alias("next")), "anchored-leads")
        maps.append(leads.where("kind = 1").select("node", "next"))
        fresh = leads.select("next.*").distinct()
        entries = intermediate(fresh.alias("f").join(known.alias("k"), _same(_KEY, "f", "k"), "left_anti"),
                               "anchored-entries")
        if entries.isEmpty():
            break

    release(rows)
    edges, segments = maps[0], scans[0]
    for m, s in zip(maps[1:], scans[1:]):
        edges, segments = edges.unionByName(m), segments.unionByName(s)
    first = known.where("not entered").select(F.struct(*_KEY).alias("node"))
    passed = _reachable(edges, first).select("node.*")
    kept = segments.alias("s").join(passed.alias("p"), _same(_KEY, "s", "p"), "left_semi")
    adt, bdt = F.timestamp_seconds("ats"), F.timestamp_seconds("bts")
    t = elapsed_seconds(adt, bdt).cast("double")
    d = haversine_km("alat", "alon", "blat", "blon")
    return kept.select("id", "alat", "alon", "blat", "blon", adt.alias("adt"), bdt.alias("bdt"),
                       t.alias("time_s"), d.alias("distance_km"),
                       speed_kmh(d, t, zero_time=zero_time_velocity).alias("velocity_kmh"))
