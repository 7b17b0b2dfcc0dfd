"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

*Building.*  Vectors get one more component that gives all of them the length
of the longest, so the largest inner product is also the shortest distance.
A first graph comes from exact search inside blocks of random-projection
buckets.  Then, round by round, each vertex brings its neighbours and those it
is a neighbour of together: neighbours' vectors meet there
and every pair of neighbours that is new at this vertex is compared.  A pair
that beats the worst neighbour of one of the two goes to it, and each keeps its
best ``degree``.  Rounds end when at most ``settled`` of all neighbours change.

*Searching.*  All queries search at once.  Each holds a beam of its best
``beam`` vertices; a round joins the best ones not looked at yet (``width``, twice
as many each round) with the vertices' adjacency lists (ids of neighbours in both
directions).  What comes back is
scored block by block of vertices, and what isn't worse than the beam's worst
goes into the beam.  Scores are those of the vectors as given, so the whole
beam is exact and near copies are told apart.  Rounds end when no beam holds a
vertex not looked at yet.

Vectors are never coded: they go through both as they were given (``float`` as
float32, all else as float64), arithmetic is double.  The component that makes
up for the length is kept as its difference to the longest length, small where
vectors are short, and vertices are compared by distance, so one long vector
takes no digits from the others.  A vector is sent once to every block that
needs it, not once to every list it is on.  For building, blocks are cells of
the nearest of at least ``cells`` centres, clustered from the sample of entry
points, so the lists of near vertices share what is sent: a vector goes to about
ten of 16 cells where there is hardly any structure, whatever the number of
vertices.  Cells with more than ``block`` vertices (fewer, if vectors are long)
are cut by id, and no vector goes to more than the lists it is on.  Equal
vectors are one vertex, and its ``k + 1`` smallest ids stand for all of them,
which is exact for ``k`` neighbours.

*Entry points.*  A beam starts from its query's own vertex, whose list the graph
holds, and from the best ``starts`` vertices found in a sample of an eighth of
all, which is searched by a graph of its own in the same way, and so on down to
a sample of at most ``entries``, the only thing that is broadcast.  Close groups
that are a closed part of the graph of all have few members in a sample, whose
lists lead out of the group: these are the long edges.

Lists a vertex gathers are bounded by ``degree`` in either direction; rows of
a vertex are read in order as a stream and never collected.

Defined results: a vector that is null, zero or holds a null or non-finite
component, and one whose length differs from the most frequent length, takes
no part, neither does a null id; if there are fewer candidates than ``k`` all
found are returned; ties go to the smaller id; rows that repeat an id must be
equal and count once; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType
from pyspark.sql.window import Window

from canopy.llm.common import arrow_map, stored

Groups = Iterator[tuple[int, dict[str, list]]]


def streamed(df: DataFrame, key: str, order: list, columns: list[str], work: Callable[[Groups], Iterator[dict]], schema: str) -> DataFrame:
    """Deal the rows out by ``key``, sort them, and hand ``work`` runs of one key.

    A key's rows may come as several runs (a batch ends one), so ``work`` keeps
    what it needs between them; no run is larger than an Arrow batch.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    parsed = StructType.fromDDL(schema)
    at = columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(parsed)

        def groups() -> Groups:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = batch.column(at).to_numpy()
                cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
                lists = [batch.column(k).to_pylist() for k in range(len(columns))]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    yield int(keys[a]), {c: x[a:b] for c, x in zip(columns, lists, strict=True)}

        held, n = {f: [] for f in parsed.fieldNames()}, 0
        for row in work(groups()):
            for f in held:
                held[f].append(row[f])
            n += 1
            if n == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(held[f.name], f.type) for f in arrow], schema=arrow)
                held, n = {f: [] for f in held}, 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(held[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*columns).repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def merged_runs(groups: Groups) -> Groups:
    """Runs of one key as one; for keys with a bounded number of rows."""
    key, held = None, None
    for k, rows in groups:
        if k == key:
            for c, x in rows.items():
                held[c] += x
        else:
            if held is not None:
                yield key, held
            key, held = k, rows
    if held is not None:
        yield key, held


# ------------------------------------------------------------------ vectors


def lossless(df: DataFrame, vector_col: str) -> str:
    """The numpy type that holds every component as it is."""
    element = getattr(df.schema[vector_col].dataType, "elementType", None)
    return "<f4" if isinstance(element, FloatType) else "<f8"


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dims, norm2, d1, d2`` (digest) and ``data`` (doubles) of the vectors that take part."""

    def rows(given):
        out = {c: [] for c in ("id", "dims", "norm2", "d1", "d2", "data")}
        for i, v in zip(given[id_col], given[vector_col], strict=True):
            if i is None or not v or any(c is None for c in v):
                continue
            x = np.array(v, np.float64) + 0.0  # a negative zero is a zero
            norm2 = float(x @ x)
            if not np.isfinite(x).all() or not math.isfinite(norm2) or not x.any():
                continue
            data = x.astype("<f8").tobytes()
            digest = xxhash.xxh128_digest(data)
            out["id"].append(i)
            out["dims"].append(len(v))
            out["norm2"].append(norm2)
            out["d1"].append(int.from_bytes(digest[:8], "big", signed=True))
            out["d2"].append(int.from_bytes(digest[8:], "big", signed=True))
            out["data"].append(data)
        yield out

    return arrow_map(df, [id_col, vector_col], rows, "id long, dims int, norm2 double, d1 long, d2 long, data binary")


def vertices(vectors: DataFrame, longest2: float, kind: str, blocks: int) -> DataFrame:
    """``id, block, point``: the vectors, and by how much their further component is below the longest length."""

    def rows(given):
        x = np.stack([np.frombuffer(d, "<f8") for d in given["data"]])
        norm2 = np.array(given["norm2"])
        below = norm2 / (math.sqrt(longest2) + np.sqrt(np.maximum(longest2 - norm2, 0)))
        below = np.minimum(below, np.finfo(kind).max)
        points = np.concatenate([x, below[:, None]], axis=1).astype(kind)
        block = block_of(np.array(given["id"]), blocks)
        yield {"id": given["id"], "block": block.tolist(), "point": [p.tobytes() for p in points]}

    return arrow_map(vectors, ["id", "norm2", "data"], rows, "id long, block long, point binary")


def points_of(data: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)


def closeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minus half the squared distances, which order like inner products of the lengthened vectors."""
    return np.minimum(a @ b.T - (a * a).sum(axis=1)[:, None] / 2 - (b * b).sum(axis=1) / 2, 0)


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


# ---------------------------------------------------------------- the graph


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` highest scores, best first, ties to the smaller id."""
    if len(ids) > 4 * k:
        near = np.argpartition(-scores, k)[: k + 1]
        near = np.flatnonzero(scores >= scores[near].min())
    else:
        near = np.arange(len(ids))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


#: Vectors that the lists of one block may need, in bytes; centres that vertices are compared with.
CELL_BYTES, MOST_CELLS = 64 << 20, 256
CANDIDATES = "id long, ids binary, scores binary"


def candidate(i: int, ids: np.ndarray, scores: np.ndarray, kind: str = "<f4") -> dict:
    return {"id": i, "ids": ids.astype("<i8").tobytes(), "scores": scores.astype(kind).tobytes()}


def first_candidates(nodes: DataFrame, n: int, sample: np.ndarray, kind: str, degree: int, leaf: int, tables: int, seed: int) -> DataFrame:
    """Neighbours inside blocks of at most about ``leaf`` vertices of random-projection buckets."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / leaf)))
    planes = np.random.default_rng(seed).standard_normal((sample.shape[1], tables * bits))
    middle = np.median(sample @ planes, axis=0)  # halves the vertices, as far as the sample tells

    def place(given):
        x = points_of(given["point"], kind)
        side = (x @ planes > middle).reshape(len(x), tables, bits)
        bucket = (side * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2) * tables + np.arange(tables)
        yield {"bucket": bucket.ravel().tolist(), **{c: [v for v in given[c] for _ in range(tables)] for c in ("id", "point")}}

    placed = arrow_map(nodes, ["id", "point"], place, "bucket long, id long, point binary")
    sizes = placed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / leaf).alias("parts"))
    dealt = placed.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("id", "bucket"), F.col("parts")))
    dealt = dealt.withColumn("block", F.xxhash64("bucket", "part"))

    def search(groups: Groups) -> Iterator[dict]:
        for _, rows in merged_runs(groups):
            x, ids = points_of(rows["point"], kind), np.array(rows["id"])
            for at in range(0, len(ids), 512):
                scores = closeness(x[at : at + 512], x)
                scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
                for k, row in enumerate(scores):
                    top = best(ids, row, min(degree, len(ids) - 1))
                    if len(top):
                        yield candidate(int(ids[at + k]), ids[top], row[top])

    return streamed(dealt, "block", ["id"], ["block", "id", "point"], search, CANDIDATES)


GRAPH = "id long, ids binary, scores binary, fresh binary, changed int"


def kept_neighbours(graph: DataFrame, candidates: DataFrame, degree: int) -> DataFrame:
    """Each vertex's best ``degree`` of its list and the candidates; what was not in the list is fresh."""
    rows = graph.select("id", "ids", "scores", F.lit(0).alias("kind"))
    rows = rows.unionByName(candidates.withColumn("kind", F.lit(1)))

    def merge(groups: Groups) -> Iterator[dict]:
        own = None

        def row():
            ids, scores, fresh = own["list"]
            return {
                "id": own["id"], "changed": int(fresh.sum()),
                "ids": ids.astype("<i8").tobytes(), "scores": scores.astype("<f4").tobytes(), "fresh": fresh.tobytes(),
            }

        for i, rows in groups:
            if own is None or own["id"] != i:
                if own is not None:
                    yield row()
                own = {"id": i, "list": (np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, bool))}
            old_ids, old_scores, old_fresh = own["list"]
            ids = np.frombuffer(b"".join(rows["ids"]), "<i8")
            scores = np.frombuffer(b"".join(rows["scores"]), "<f4")
            listed = len(rows["ids"][0]) // 8 if rows["kind"][0] == 0 else 0
            fresh = np.arange(len(ids)) >= listed
            ids, scores, fresh = (np.concatenate(x) for x in ((old_ids, ids), (old_scores, scores), (old_fresh, fresh)))
            _, first = np.unique(ids, return_index=True)  # the listed one comes first and stays as it is
            first = first[ids[first] != i]
            first = first[best(ids[first], scores[first], degree)]
            own["list"] = ids[first], scores[first], fresh[first]
        if own is not None:
            yield row()

    return streamed(rows, "id", ["kind"], ["id", "kind", "ids", "scores"], merge, GRAPH)


def neighbourhoods(graph: DataFrame, degree: int) -> DataFrame:
    """``v, ids, fresh``: each vertex with its neighbours and the best ``degree`` it is a neighbour of."""

    def edges(given):
        v, u, s, f, way = [], [], [], [], []
        for i, ids, scores, fresh in zip(given["id"], given["ids"], given["scores"], given["fresh"], strict=True):
            ids = np.frombuffer(ids, "<i8").tolist()
            n = len(ids)
            own = [i] * n
            v += own + ids
            u += ids + own
            s += np.frombuffer(scores, "<f4").tolist() * 2
            f += np.frombuffer(fresh, bool).tolist() * 2
            way += [0] * n + [1] * n
        yield {"v": v, "u": u, "score": s, "fresh": f, "way": way}

    both = arrow_map(graph, ["id", "ids", "scores", "fresh"], edges, "v long, u long, score float, fresh boolean, way int")

    def choose(groups: Groups) -> Iterator[dict]:
        vertex, back, seen = None, 0, {}

        def row():
            return {"v": vertex, "ids": np.array(list(seen), "<i8").tobytes(), "fresh": bytes(seen.values())}

        for v, rows in groups:
            if v != vertex:
                if vertex is not None:
                    yield row()
                vertex, back, seen = v, 0, {}
            for way, u, fresh in zip(rows["way"], rows["u"], rows["fresh"], strict=True):
                back += way
                if back <= degree:
                    seen.setdefault(u, fresh)
        if vertex is not None:
            yield row()

    order = [F.col("way"), F.col("score").desc(), F.col("u")]
    return streamed(both, "v", order, ["v", "way", "score", "u", "fresh"], choose, "v long, ids binary, fresh binary")


def centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Means of the sample's clusters; a cluster that loses all its points keeps its mean."""
    found = sample[:cells].copy()
    for _ in range(8):
        at = np.argmax(closeness(sample, found), axis=1)
        size = np.bincount(at, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, at, sample)
        found = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], found)
    return found


def homes(nodes: DataFrame, means: np.ndarray, kind: str, block: int) -> DataFrame:
    """``id, block``: the cell each vertex is in, cut into parts of about ``block`` vertices."""

    def rows(given):
        yield {"id": given["id"], "cell": np.argmax(closeness(points_of(given["point"], kind), means), axis=1).tolist()}

    placed = stored(arrow_map(nodes, ["id", "point"], rows, "id long, cell int"), "ann-cells")
    size = dict(placed.groupBy("cell").count().collect())  # one number a centre
    parts = F.array(*[F.lit(math.ceil(size.get(k, 0) / block) or 1) for k in range(len(means))])
    part = F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("cell") + 1))
    return placed.select("id", (part * len(means) + F.col("cell")).alias("block"))


def compared(graph: DataFrame, nodes: DataFrame, home: DataFrame, kind: str, degree: int, sent: int) -> DataFrame:
    """Candidates from comparing, at every vertex, each fresh neighbour with all of its neighbours."""
    lists = neighbourhoods(graph, degree).join(home.withColumnRenamed("id", "v"), "v")
    members = stored(lists.select("v", "block", "ids", "fresh"), "ann-members")

    def needed(given):
        pairs = {(b, u) for b, ids in zip(given["block"], given["ids"], strict=True) for u in np.frombuffer(ids, "<i8").tolist()}
        yield {"block": [b for b, _ in pairs], "id": [u for _, u in pairs]}

    needs = arrow_map(members.where(F.length("ids") > 8), ["block", "ids"], needed, "block long, id long").distinct()
    full = F.length("ids") >= 8 * degree
    last = F.when(full, F.substring("scores", -4, 4))  # a list that isn't full takes everything
    known = nodes.drop("block").join(graph.select("id", last.alias("worst")), "id")
    rows = needs.join(known, "id").withColumn("kind", F.lit(0))
    rows = rows.unionByName(members.select("block", F.col("v").alias("id"), "ids", "fresh", F.lit(1).alias("kind")), allowMissingColumns=True)

    def compare(groups: Groups) -> Iterator[dict]:
        held = []

        def flush():
            if not held:
                return
            u, w, s = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((w, u))
            u, w, s = u[order], w[order], s[order]
            new = np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
            u, w, s = u[new], w[new], s[new]
            cuts = [0, *(np.flatnonzero(u[1:] != u[:-1]) + 1).tolist(), len(u)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield candidate(int(u[a]), w[a:b], s[a:b])

        block, place = None, {}
        for b, rows in groups:
            if b != block:
                yield from flush()
                block, place, count = b, {}, 0
                parts_x, parts_w, x = [], [], None
            known = rows["kind"].count(0)
            if known:
                place.update(zip(rows["id"][:known], range(count, count + known), strict=True))
                count += known
                parts_x.append(np.frombuffer(b"".join(rows["point"][:known]), kind).reshape(known, -1))
                parts_w.append(np.array([np.frombuffer(w, "<f4")[0] if w else -np.inf for w in rows["worst"][:known]], np.float32))
            for packed, flags in zip(rows["ids"][known:], rows["fresh"][known:], strict=True):
                ids, fresh = np.frombuffer(packed, "<i8"), np.frombuffer(flags, bool)
                if not fresh.any() or len(ids) < 2:
                    continue
                if x is None:
                    x, worsts = np.concatenate(parts_x), np.concatenate(parts_w)
                at = [place[u] for u in ids.tolist()]
                near = x[at].astype(np.float64)
                scores = closeness(near, near).astype(np.float32)
                usable = (fresh[:, None] | fresh[None, :]) & (scores > worsts[at][:, None])
                np.fill_diagonal(usable, False)
                scores = np.where(usable, scores, -np.inf)
                n = min(sent, len(ids) - 1)
                top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                k, chosen = np.nonzero(np.take_along_axis(usable, top, axis=1))
                chosen = top[k, chosen]
                held.append((ids[k], ids[chosen], scores[k, chosen]))
                if len(held) == 256:
                    yield from flush()
        yield from flush()

    columns = ["block", "kind", "id", "point", "worst", "ids", "fresh"]
    return streamed(rows, "block", ["kind", "id"], columns, compare, CANDIDATES)


def build_graph(
    nodes: DataFrame, home: DataFrame, sample: np.ndarray, kind: str, *, degree: int, leaf: int, tables: int, sent: int, settled: float, seed: int
) -> DataFrame:
    n = nodes.count()
    start = nodes.select("id", F.lit(b"").alias("ids"), F.lit(b"").alias("scores"))
    graph = stored(kept_neighbours(start, first_candidates(nodes, n, sample, kind, degree, leaf, tables, seed), degree), "ann-graph")
    while True:  # lists only get better, so this ends
        graph = stored(kept_neighbours(graph, compared(graph, nodes, home, kind, degree, sent), degree), "ann-graph")
        if graph.agg(F.sum("changed")).first()[0] <= settled * degree * n:
            break
    return graph


# --------------------------------------------------------------- the search

BEAM = "id long, point binary, ids binary, scores binary, seen binary, open int"
#: A sample of entry points holds one in so many vertices of the next larger one.
LEVEL = 8
#: Ids that one row of a block's work may hold.
ROW_IDS = 512


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products that don't depend on what else is scored along."""
    return (x * q).sum(axis=1)


def first_beams(queries: DataFrame, entry_ids: np.ndarray, entries: np.ndarray, kind: str, beam: int, starts: int) -> DataFrame:
    def rows(given):
        q = points_of(given["point"], kind)
        scores = q[:, :-1] @ entries[:, :-1].T  # the inner product is that of the vectors as they were
        out = {c: [] for c in ("id", "point", "ids", "scores", "seen", "open")}
        for k, i in enumerate(given["id"]):
            other = np.flatnonzero(entry_ids != i)
            top = other[best(entry_ids[other], scores[k, other], min(starts, beam))]
            exact = products(entries[top, :-1], q[k, :-1])
            top, exact = (z[np.lexsort((entry_ids[top], -exact))] for z in (top, exact))
            for c, x in (
                ("id", i), ("point", given["point"][k]), ("open", len(top)), ("seen", bytes(len(top))),
                ("ids", entry_ids[top].astype("<i8").tobytes()), ("scores", exact.astype("<f8").tobytes()),
            ):
                out[c].append(x)
        yield out

    return arrow_map(queries, ["id", "point"], rows, BEAM)


def reopened(beams: DataFrame, kind: str) -> DataFrame:
    """The beams with their query's own vertex, nothing looked at yet."""

    def rows(given):
        out = {c: [] for c in ("id", "point", "ids", "scores", "seen", "open")}
        for i, point, ids, scores in zip(*(given[c] for c in ("id", "point", "ids", "scores")), strict=True):
            ids, scores = np.frombuffer(ids, "<i8"), np.frombuffer(scores, "<f8")
            if i not in ids:
                x = points_of([point], kind)[:, :-1]
                ids, scores = np.append(ids, i), np.append(scores, products(x, x[0]))
            order = np.lexsort((ids, -scores))
            for c, x in (
                ("id", i), ("point", point), ("open", len(ids)), ("seen", bytes(len(ids))),
                ("ids", ids[order].tobytes()), ("scores", scores[order].tobytes()),
            ):
                out[c].append(x)
        yield out

    return arrow_map(beams, ["id", "point", "ids", "scores"], rows, BEAM)


def looked_at(beams: DataFrame, lists: DataFrame, nodes: DataFrame, kind: str, blocks: int, beam: int, width: int) -> DataFrame:
    """Neighbours of each beam's best unseen vertices that aren't worse than the beam's worst."""

    def ask(given):
        out = {c: [] for c in ("vertex", "query")}
        for q, ids, seen in zip(*(given[c] for c in ("id", "ids", "seen")), strict=True):
            unseen = np.flatnonzero(~np.frombuffer(seen, bool))[:width]
            out["vertex"] += np.frombuffer(ids, "<i8")[unseen].tolist()
            out["query"] += [q] * len(unseen)
        yield out

    asking = beams.where("open > 0")
    asked = arrow_map(asking, ["id", "ids", "seen"], ask, "vertex long, query long", slice_rows=64)
    # a vertex that many beams look at is a skewed key of a plain join, which AQE splits
    heard = asked.join(lists.select(F.col("v").alias("vertex"), "ids"), "vertex").select(F.col("query").alias("id"), "ids")
    both = asking.select("id", F.lit(0).alias("kind"), "point", "ids", "scores")
    both = both.unionByName(heard.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def gather(groups: Groups) -> Iterator[dict]:
        for q, rows in merged_runs(groups):  # at most ``width`` lists
            scores = np.frombuffer(rows["scores"][0], "<f8")
            worst = float(scores[-1]) if len(scores) >= beam else -math.inf
            new = np.setdiff1d(np.frombuffer(b"".join(rows["ids"][1:]), "<i8"), np.frombuffer(rows["ids"][0], "<i8"))
            new = new[new != q]
            block = block_of(new, blocks)
            order = np.lexsort((new, block))
            new, block = new[order], block[order]
            ends = np.flatnonzero(block[1:] != block[:-1]) + 1
            for part in np.split(np.arange(len(new)), ends):
                for at in range(0, len(part), ROW_IDS):
                    some = part[at : at + ROW_IDS]
                    yield {"block": int(block[some[0]]), "kind": 1, "id": q, "point": rows["point"][0], "worst": worst, "ids": new[some].tobytes()}

    columns = ["id", "kind", "point", "ids", "scores"]
    wanted = streamed(both, "id", ["kind"], columns, gather, "block long, kind int, id long, point binary, worst double, ids binary")
    rows = wanted.unionByName(nodes.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def score(groups: Groups) -> Iterator[dict]:
        block = None
        for b, rows in groups:
            if b != block:
                block, parts, parts_x, ids, x = b, [], [], None, None
            known = rows["kind"].count(0)
            if known:
                parts.append(np.array(rows["id"][:known], np.int64))
                parts_x.append(points_of(rows["point"][:known], kind)[:, :-1])
            if known < len(rows["id"]) and x is None:
                ids, x = np.concatenate(parts), np.concatenate(parts_x)
            for q, point, worst, packed in zip(*(rows[c][known:] for c in ("id", "point", "worst", "ids")), strict=True):
                near = np.frombuffer(packed, "<i8")
                scores = products(x[np.searchsorted(ids, near)], points_of([point], kind)[0, :-1])
                better = np.flatnonzero(scores >= worst)
                better = better[best(near[better], scores[better], beam)]
                if len(better):
                    yield candidate(q, near[better], scores[better], "<f8")

    return streamed(rows, "block", ["kind", "id"], ["block", "kind", "id", "point", "worst", "ids"], score, CANDIDATES)


def next_beams(beams: DataFrame, found: DataFrame, beam: int, width: int) -> DataFrame:
    rows = beams.withColumn("kind", F.lit(0)).unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def merge(groups: Groups) -> Iterator[dict]:
        own = None
        for i, rows in groups:
            if own is None or own["id"] != i:
                if own is not None:
                    yield own
                own = {c: rows[c][0] for c in ("id", "point", "ids", "scores")}
                seen = ~np.frombuffer(rows["seen"][0], bool)  # unseen ones, of which the first ``width`` were asked
                seen = ~(seen & (np.cumsum(seen) > width))
                own["seen"] = seen.tobytes()
                rows = {c: x[1:] for c, x in rows.items()}
            ids = np.frombuffer(own["ids"] + b"".join(rows["ids"]), "<i8")
            scores = np.frombuffer(own["scores"] + b"".join(rows["scores"]), "<f8")
            seen = np.zeros(len(ids), bool)
            seen[: len(own["seen"])] = np.frombuffer(own["seen"], bool)
            _, first = np.unique(ids, return_index=True)
            first = first[best(ids[first], scores[first], beam)]
            own["ids"], own["scores"], own["seen"] = ids[first].tobytes(), scores[first].tobytes(), seen[first].tobytes()
            own["open"] = int((~seen[first]).sum())
        if own is not None:
            yield own

    columns = ["id", "kind", "point", "ids", "scores", "seen"]
    return streamed(rows, "id", ["kind"], columns, merge, BEAM)


def scored_pairs(beams: DataFrame, most: int) -> DataFrame:
    """``vertex, near, score``: the first ``most`` of each beam but for the query itself.

    Beams are in order of score, then id, and a vertex goes by its smallest id:
    no id of a later vertex is among the first ``most`` ids.
    """

    def pairs(given):
        out = {"vertex": [], "near": [], "score": []}
        for q, ids, scores in zip(given["id"], given["ids"], given["scores"], strict=True):
            near, scores = np.frombuffer(ids, "<i8"), np.frombuffer(scores, "<f8")
            other = np.flatnonzero(near != q)[:most]
            out["vertex"] += [q] * len(other)
            out["near"] += near[other].tolist()
            out["score"] += scores[other].tolist()
        yield out

    return arrow_map(beams, ["id", "ids", "scores"], pairs, "vertex long, near long, score double", slice_rows=64)


def nearest(
    df: DataFrame,
    is_query: Callable[[Column], Column],
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    degree: int = 28,
    leaf: int = 384,
    tables: int = 3,
    sent: int = 8,
    settled: float = 0.05,
    entries: int = 2048,
    starts: int = 48,
    beam: int = 400,
    width: int = 128,
    block: int = 4096,
    cells: int = 16,
    seed: int = 3,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id ``is_query`` holds for."""
    vectors = stored(usable_vectors(df.select(id_col, vector_col), id_col, vector_col).dropDuplicates(["id"]), "ann-vectors")
    size = vectors.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    vectors = vectors.where(F.col("dims") == (size.dims if size else 0))
    longest2 = vectors.agg(F.max("norm2")).first()[0] or 0.0
    classes = vectors.groupBy("d1", "d2").agg(F.min("id").alias("vertex"))
    classes = stored(classes, "ann-classes")
    heads = vectors.join(classes.select(F.col("vertex").alias("id")), "id", "left_semi")
    kind = lossless(df, vector_col)
    n = classes.count()
    blocks = max(1, math.ceil(n / block))
    nodes = stored(vertices(heads, longest2, kind, blocks), "ann-vertices")
    sample = nodes.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(entries).collect()
    sample_ids = np.array([r.id for r in sample], np.int64)
    sample_x = points_of([r.point for r in sample], kind) if sample else np.zeros((0, 1))
    member = vectors.join(classes, ["d1", "d2"]).select("vertex", "id")
    asking = member.where(is_query(F.col("id"))).select(F.col("id").alias("query_id"), "vertex")
    found = None
    if len(sample):
        queries = nodes.join(asking.select(F.col("vertex").alias("id")).distinct(), "id", "left_semi")
        beams = first_beams(queries, sample_ids, sample_x, kind, beam, starts)
        held = min(block, max(64, CELL_BYTES // (2 * degree * len(sample[0].point))))
        home = homes(nodes, centres(sample_x, min(MOST_CELLS, max(cells, math.ceil(n / held)))), kind, held)
        shares = [1]  # one in so many of the vertices
        while n / shares[-1] / LEVEL > entries:
            shares.append(shares[-1] * LEVEL)
        for share in reversed(shares):
            some = nodes.where(F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(share)) == 0)
            graph = build_graph(some, home, sample_x, kind, degree=degree, leaf=leaf, tables=tables, sent=sent, settled=settled, seed=seed)
            lists = stored(neighbourhoods(graph, degree).select("v", "ids"), "ann-lists")
            # all starts are looked at at once, the query's own vertex as well
            size, first = beam if share == 1 else starts, max(width, starts + 1)
            beams = stored(reopened(beams, kind), "ann-beams")
            while True:  # no vertex is looked at twice by a beam, so this ends
                beams = stored(next_beams(beams, looked_at(beams, lists, some, kind, blocks, size, first), size, first), "ann-beams")
                if not beams.agg(F.sum("open")).first()[0]:
                    break
                first = min(2 * first, size)  # what is still in a beam later on mostly stays, so it is looked at sooner
        found = scored_pairs(beams, k + 1)
    else:
        found = df.sparkSession.createDataFrame([], "vertex long, near long, score double")
    # a query's own vertex is as near as it gets: its other members are candidates as well
    own = vectors.select(F.col("id").alias("vertex"), F.col("norm2").alias("score"))
    own = own.join(asking.select("vertex").distinct(), "vertex").select("vertex", F.col("vertex").alias("near"), "score")
    order = Window.partitionBy("vertex").orderBy("id")
    first = member.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    first = first.select(F.col("vertex").alias("near"), F.col("id").alias("vec_id"))
    pairs = found.unionByName(own).join(first, "near")
    # equal queries have one list: its first k + 1 ids, of which each query leaves out its own
    place = F.row_number().over(Window.partitionBy("vertex").orderBy(F.desc("score"), "vec_id"))
    listed = pairs.withColumn("place", place).where(F.col("place") <= k + 1)
    lists = listed.groupBy("vertex").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    own_list = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = asking.join(lists, "vertex").select("query_id", F.posexplode(own_list).alias("at", "near"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "near.vec_id", "near.score")
