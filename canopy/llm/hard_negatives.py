"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows are put in the order of a Hilbert curve through their vectors' space and
written as *blocks*: one Parquet row each, with the vectors of ``block_rows`` rows and,
beside them, a *zone map*: each dimension's least and greatest component and the
least and greatest label.  Zone maps are read without the vectors.

A search asks, for each anchor, for the best rows with a score in given
*windows*.  Interval arithmetic bounds the inner product of an anchor with any
vector of a block -- per dimension the greater (or the smaller) of anchor times
least and anchor times greatest component, summed -- and only blocks whose
interval meets one of the windows, and whose labels can match, are joined to the
anchor.  There the scores are exact.  Two searches make the result:

* positives: rows of the anchor's label, in the window from the ``positives``-th best
  score in the anchor's own block upwards.  That score is known when the block is
  written out, and on the curve the own block is where near rows are;
* negatives: rows of other labels, one window for each positive; if the own block
  has ``negatives`` rows in it, their worst score is the window's lower end.

Anchors go in batches of ``batch_rows`` in the order of the curve, so that those of a
batch ask for the same blocks; tasks keep the best rows of each window they meet
and Spark takes the best of the tasks' answers.  Blocks are equal in size however
many rows share a vector, a label or an id, so there is no hot key.

Components become ``floor(256 x)``, x as double.  Inner products are exact: in double
precision while no sum can reach 2^53, otherwise in 64-bit integers; where these
could overflow, ValueError says so.

Defined results: rows with a null label, a null vector, or any null or non-finite
component take no part.  A vector shorter than others has zeros for what it lacks.
Rows with the anchor's own id are no partners of it.  A null id is no anchor and comes
last among equal scores.  Rows that repeat an id are rows of their own, as anchors and as
partners.  Windows without rows give none; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from canopy.llm.common import stored

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)
BLOCK = (
    "block long, n_rows int, n_anchors int, label_low long, label_high long, low binary, high binary, "
    "ids array<long>, labels binary, anchors binary, vectors binary"
)
ASK = "position long, id long, label long, vector binary, lows array<long>, highs array<long>"
TASK_BLOCKS = 1 << 32
LEAST, GREATEST = -(1 << 62), 1 << 62


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of rows of ``bits``-bit coordinates, as bytes that sort like them.

    Skilling's transform: undo excess work from the highest bit down, then Gray code;
    the key's bits are, bit by bit, those of all dimensions.
    """
    x = cells.astype(np.uint32).T.copy()  # dimensions x rows
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(len(x)):
            inverted = (x[i] & np.uint32(q)) != 0
            swap = np.where(inverted, np.uint32(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(inverted, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.uint32), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = np.concatenate([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)])
    packed = np.packbits(planes.T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """``floor(256 x)`` of a list column as rows of ``width`` numbers, as double."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = np.floor(flat * 256)
    return out


class Box:
    """Each dimension's least and greatest whole number, and the types that hold them exactly."""

    def __init__(self, low: list[float], high: list[float]):
        self.low, self.high = np.array(low), np.array(high)
        self.width = len(low)
        most = max((abs(v) for v in (*low, *high)), default=0.0)
        reach = self.width * int(most) ** 2
        if reach >= 1 << 62 or most >= 1 << 62:
            raise ValueError("inner products that need more than 64 bits")
        self.stored = next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)
        self.exact = np.float64 if reach < 1 << 53 else np.int64

    def read(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.stored).reshape(-1, self.width).astype(self.exact)

    def cells(self, numbers: np.ndarray, bits: int) -> np.ndarray:
        """Coordinates of ``bits`` bits: the box cut evenly."""
        side = np.maximum(self.high - self.low, 1.0)
        return np.minimum(((numbers - self.low) / side * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def box_of(rows: DataFrame) -> Box | None:
    """One row a dimension comes to the driver, and (as dimension -1) the vectors' lengths; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, shortest, longest = np.zeros(0), np.zeros(0), np.inf, -np.inf
        for batch in batches:
            vectors = batch.column(0)
            sizes = np.diff(vectors.offsets.to_numpy())
            if not len(sizes):
                continue
            shortest, longest = min(shortest, sizes.min()), max(longest, sizes.max())
            width = max(int(longest), len(low))
            low = np.append(low, np.full(width - len(low), np.inf))
            high = np.append(high, np.full(width - len(high), -np.inf))
            numbers = whole_numbers(vectors, width)
            low = np.minimum(low, numbers.min(axis=0, initial=np.inf))
            high = np.maximum(high, numbers.max(axis=0, initial=-np.inf))
        if longest >= 0:
            columns = np.arange(-1, len(low)), np.append(shortest, low), np.append(longest, high)
            arrays = [pa.array(columns[0], pa.int32()), pa.array(columns[1]), pa.array(columns[2])]
            yield pa.RecordBatch.from_arrays(arrays, ["dim", "low", "high"])

    parts = rows.select("vector").mapInArrow(run, "dim int, low double, high double")
    found = parts.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    if not found:
        return None
    sizes, *found = found
    zero = sizes.low < sizes.high  # what a short vector lacks counts as zero
    low = [min(r.low, 0.0) if zero else r.low for r in found] or [0.0]
    high = [max(r.high, 0.0) if zero else r.high for r in found] or [0.0]
    return Box(low, high)


def write_blocks(rows: DataFrame, box: Box, block_rows: int, bits: int) -> DataFrame:
    """The rows in Hilbert order as blocks with zone maps (``BLOCK``)."""
    keyed_schema = "key binary, place long, id long, label long, anchor boolean, vector binary"

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                numbers = whole_numbers(batch.column(3), box.width)
                keys = hilbert_keys(box.cells(numbers, bits), bits)
                vectors = [v.tobytes() for v in numbers.astype(box.stored)]
                places = np.arange(place, place + batch.num_rows)
                place += batch.num_rows
                columns = [pa.array(keys, pa.binary()), pa.array(places), *(batch.column(k) for k in range(3))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(vectors, pa.binary())], ["key", "place", "id", "label", "anchor", "vector"]
                )

    parsed = StructType.fromDDL(BLOCK)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, number, parts, n = to_arrow_schema(parsed), TaskContext.get().partitionId() * TASK_BLOCKS, [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            labels = table.column("label").to_numpy()
            data = b"".join(table.column("vector").to_pylist())
            vectors = np.frombuffer(data, box.stored).reshape(-1, box.width)
            anchors = table.column("anchor").to_numpy()
            row = {
                "block": number,
                "n_rows": len(labels),
                "n_anchors": int(anchors.sum()),
                "label_low": labels.min(),
                "label_high": labels.max(),
                "low": vectors.min(axis=0).tobytes(),
                "high": vectors.max(axis=0).tobytes(),
                "ids": table.column("id").to_pylist(),
                "labels": labels.astype("<i8").tobytes(),
                "anchors": anchors.astype(np.uint8).tobytes(),
                "vectors": data,
            }
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            parts.append(batch)
            n += batch.num_rows
            if n >= block_rows:
                table, at = pa.Table.from_batches(parts), 0
                while n - at >= block_rows:
                    yield block(table.slice(at, block_rows))
                    number, at = number + 1, at + block_rows
                parts, n = table.slice(at).to_batches(), n - at
        if n:
            yield block(pa.Table.from_batches(parts))

    keyed = rows.select("id", "label", "anchor", "vector").mapInArrow(key, keyed_schema)
    ordered = keyed.repartitionByRange("key", "id", "place").sortWithinPartitions("key", "id", "place")
    return stored(ordered.select("id", "label", "anchor", "vector").mapInArrow(pack, BLOCK), "negatives-blocks")


def running(blocks: DataFrame, column: Column) -> DataFrame:
    """``block`` and the sum of ``column`` over the blocks before it: by task, then within a task."""
    sized = blocks.select("block", F.shiftright("block", 32).alias("task"), column.cast("long").alias("n"))
    tasks = sized.groupBy("task").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("task").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = sized.select("task", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("own"))
    return own.join(tasks, "task").select("block", (F.col("base") + F.col("own")).alias("before"))


def find_anchors(blocks: DataFrame, box: Box, positives: int) -> DataFrame:
    """Every anchor with what its own block says: the ``positives``-th best score of its label
    (``LEAST`` if there are fewer) and the scores of other labels."""
    schema = "position long, id long, label long, vector binary, seed long, others binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(k)[at] for k, n in enumerate(batch.schema.names)}
                slots = np.flatnonzero(np.frombuffer(row["anchors"].as_py(), np.uint8))
                labels, vectors = np.frombuffer(row["labels"].as_py(), "<i8"), box.read(row["vectors"].as_py())
                ids = row["ids"].as_py()
                same_id: dict[int | None, list[int]] = {}
                for k, i in enumerate(ids):
                    same_id.setdefault(i, []).append(k)
                out: list[list] = [[] for _ in range(6)]
                scores = (vectors[slots] @ vectors.T).astype(np.int64)
                for k, slot in enumerate(slots.tolist()):
                    partner = np.ones(len(ids), bool)
                    partner[same_id[ids[slot]]] = False
                    alike = labels == labels[slot]
                    own = np.sort(scores[k][partner & alike])[::-1]
                    seed = int(own[positives - 1]) if len(own) >= positives else LEAST
                    others = np.sort(scores[k][partner & ~alike]).astype("<i8").tobytes()
                    vector = vectors[slot].astype(box.stored).tobytes()
                    values = row["before"].as_py() + k, ids[slot], int(labels[slot]), vector, seed, others
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
                names = ["position", "id", "label", "vector", "seed", "others"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    with_anchors = blocks.where("n_anchors > 0")
    numbered = with_anchors.join(running(with_anchors, F.col("n_anchors")), "block")
    found = numbered.select("before", "ids", "labels", "anchors", "vectors").mapInArrow(run, schema)
    return stored(found, "negatives-anchors")


def bounds(asks: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product of each ask (rows) with any vector in each box (columns)."""
    up, down = np.maximum(asks, 0), np.minimum(asks, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def ask_matrix(asks: pa.Array, box: Box):
    """Vectors, labels and windows of a list of ``ASK`` structs."""
    vectors = box.read(b"".join(asks.field("vector").to_pylist()))
    labels = asks.field("label").to_numpy(zero_copy_only=False)
    shape = (len(asks), -1)
    lows = asks.field("lows").flatten().to_numpy(zero_copy_only=False).reshape(shape)
    highs = asks.field("highs").flatten().to_numpy(zero_copy_only=False).reshape(shape)
    return vectors, labels, lows, highs


def best_in_windows(scores, ids, known, allowed, lows, highs, k):
    """(ask, window, score, column) of each window's ``k`` best allowed scores, ties to smaller ids, nulls last."""
    found = []
    order = np.lexsort((ids, ~known))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    for w in range(lows.shape[1]):
        fits = allowed & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None])
        if not fits.any():
            continue
        masked = np.where(fits, scores, LEAST)
        if masked.shape[1] > k:  # at least the k-th best, ties with it too
            worst = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
            fits &= scores >= worst[:, None]
        ask, column = np.nonzero(fits)
        score = scores[ask, column]
        by = np.lexsort((place[column], -score, ask))
        ask, column, score = ask[by], column[by], score[by]
        first = np.searchsorted(ask, ask)
        keep = np.arange(len(ask)) - first < k
        found.append((ask[keep], np.full(keep.sum(), w), score[keep], column[keep]))
    return found


def search(asks: DataFrame, blocks: DataFrame, box: Box, k: int, same: bool, batch_rows: int, group_blocks: int) -> DataFrame:
    """``position, window, found``: the ``k`` best (score, id) in each window of each ask, rows of the ask's
    label (``same``) or of others, best first."""
    n_groups = -(-blocks.count() // group_blocks)
    place = running(blocks, F.lit(1))
    zone_columns = ("block", "label_low", "label_high", "low", "high")
    zones = blocks.select(*zone_columns).join(place, "block")
    zones = zones.groupBy(F.floor(F.col("before") / group_blocks).alias("group")).agg(
        F.collect_list(F.struct(*zone_columns)).alias("zones")
    )
    names = [f.name for f in StructType.fromDDL(ASK)]
    batches_ = asks.groupBy(F.floor(F.col("position") / batch_rows).alias("batch")).agg(
        F.collect_list(F.struct(*names)).alias("asks")
    )
    # every batch looks at every group of zone maps, not at the vectors
    looked = batches_.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))))
    looked = looked.join(zones, "group").select("asks", "zones")
    chosen_schema = StructType.fromDDL(f"block long, asks array<struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in StructType.fromDDL(ASK))}>>")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(chosen_schema)
        for batch in batches:
            for at in range(batch.num_rows):
                asked, zone = batch.column(0)[at].values, batch.column(1)[at].values
                vectors, labels, lows, highs = ask_matrix(asked, box)
                low, high = (box.read(b"".join(zone.field(c).to_pylist())) for c in ("low", "high"))
                label_low, label_high = (zone.field(c).to_numpy() for c in ("label_low", "label_high"))
                least, greatest = bounds(vectors, low, high)
                if same:
                    may = (labels[:, None] >= label_low) & (labels[:, None] <= label_high)
                else:
                    may = ~((labels[:, None] == label_low) & (labels[:, None] == label_high))
                meets = np.zeros(may.shape, bool)
                for w in range(lows.shape[1]):
                    within = (lows[:, w] <= highs[:, w])[:, None]
                    meets |= within & (greatest >= lows[:, w, None]) & (least <= highs[:, w, None])
                may &= meets
                for column, block in enumerate(zone.field("block").to_pylist()):
                    wanted = np.flatnonzero(may[:, column])
                    if len(wanted):
                        part = asked.take(pa.array(wanted))
                        offsets = pa.array([0, len(part)], pa.int32())
                        row = [pa.array([block]), pa.ListArray.from_arrays(offsets, part).cast(schema.field("asks").type)]
                        yield pa.RecordBatch.from_arrays(row, schema=schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        n = 0

        def best():
            """The k best of each (position, window) this task has met."""
            position, window, value, i, known = (np.concatenate(c) for c in zip(*pending, strict=True))
            by = np.lexsort((i, ~known, -value, window, position))
            columns = [c[by] for c in (position, window, value, i, known)]
            new = np.append(True, (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0))
            at = np.arange(len(by))
            keep = at - np.maximum.accumulate(np.where(new, at, 0)) < k
            return tuple(c[keep] for c in columns)

        def out(columns):
            position, window, value, i, known = columns
            arrays = [pa.array(position), pa.array(window, pa.int32()), pa.array(value), pa.array(i, mask=~known)]
            return pa.RecordBatch.from_arrays(arrays, ["position", "window", "score", "id"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(c)[at] for c, name in enumerate(batch.schema.names)}
                asked = row["asks"].values
                vectors, labels, lows, highs = ask_matrix(asked, box)
                ids = row["ids"].values
                known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                theirs = np.frombuffer(row["labels"].as_py(), "<i8")
                scores = (vectors @ box.read(row["vectors"].as_py()).T).astype(np.int64)
                allowed = (labels[:, None] == theirs) == same
                own = asked.field("id").to_numpy(zero_copy_only=False)
                allowed &= ~(known & (own[:, None] == ids))
                position = asked.field("position").to_numpy()
                for ask, window, value, column in best_in_windows(scores, ids, known, allowed, lows, highs, k):
                    pending.append((position[ask], window, value, ids[column], known[column]))
                    n += len(ask)
                if n > 1 << 18:
                    pending = [best()]
                    n = len(pending[0][0])
                    if n > 1 << 17:  # of too many windows to keep: what is told now competes later
                        yield out(pending[0])
                        pending, n = [], 0
        if pending:
            yield out(best())

    chosen = looked.mapInArrow(choose, chosen_schema)
    met = chosen.join(blocks.select("block", "ids", "labels", "vectors"), "block").select("asks", "ids", "labels", "vectors")
    told = met.mapInArrow(score, "position long, window int, score long, id long")
    order = F.struct((-F.col("score")).alias("s"), F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    found = told.groupBy("position", "window").agg(F.slice(F.sort_array(F.collect_list(order)), 1, k).alias("found"))
    return found.withColumn("found", F.transform("found", lambda x: F.struct((-x["s"]).alias("score"), x["id"].alias("id"))))


def windows(anchors: DataFrame, low: int, high: int, negatives: int) -> DataFrame:
    """Asks of the second search: for each of an anchor's ``positive`` scores p the scores n with
    ``low p <= 100 n <= high p``, from what the own block holds already."""
    schema = StructType.fromDDL(ASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            lows, highs = [], []
            for scores, others in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                near = np.frombuffer(others, "<i8")
                ends = [(-(-low * p // 100), high * p // 100) for p in scores]
                own = []
                for a, b in ends:
                    inside = near[np.searchsorted(near, a) : np.searchsorted(near, b, "right")] if a <= b else near[:0]
                    own.append(int(inside[-negatives]) if len(inside) >= negatives else a)
                lows.append(own)
                highs.append([b for _, b in ends])
            columns = [*(batch.column(c) for c in range(4)), pa.array(lows, arrow.field("lows").type), pa.array(highs, arrow.field("highs").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return anchors.select("position", "id", "label", "vector", "scores", "others").mapInArrow(run, schema)


def mine(
    df: DataFrame,
    anchor: Callable[[Column], Column],
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block_rows: int = 1024,
    batch_rows: int = 2048,
    group_blocks: int = 2048,
    bits: int = 2,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows whose id
    ``anchor`` picks: for each of an anchor's first ``positives`` rows of its label, the first ``negatives`` rows of
    other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score``."""
    vector = F.col(vector_col)
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    used = df.where(F.col(label_col).isNotNull() & vector.isNotNull() & finite)
    i = F.col(id_col).cast("long")
    rows = used.select(
        i.alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchor(i), F.lit(False)).alias("anchor"),
        vector.cast("array<double>").alias("vector"),
    )
    box = box_of(rows)
    if box is None:
        return df.sparkSession.createDataFrame([], RESULT)
    blocks = write_blocks(rows, box, block_rows, bits)
    anchors = find_anchors(blocks, box, positives)
    upwards = F.array("seed").alias("lows"), F.array(F.lit(GREATEST).cast("long")).alias("highs")
    first = search(anchors.select("position", "id", "label", "vector", *upwards), blocks, box, positives, True, batch_rows, group_blocks)
    # windows run along the positives; each anchor has as many, the missing ones empty (0 at no score)
    with_positives = stored(anchors.join(first.select("position", F.col("found").alias("positives")), "position"), "negatives-positives")
    score_list = F.transform("positives", lambda p: p["score"])
    padded = F.concat(score_list, F.array_repeat(F.lit(-1).cast("long"), F.lit(positives) - F.size("positives")))
    asks = windows(with_positives.withColumn("scores", padded), low, high, negatives)
    second = search(asks, blocks, box, negatives, False, batch_rows, group_blocks)
    pairs = with_positives.select("position", F.col("id").alias("anchor_id"), F.posexplode("positives").alias("window", "positive"))
    told = pairs.join(second, ["position", "window"]).select(
        "anchor_id", "positive", F.posexplode("found").alias("rank", "negative")
    )
    return told.select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("negative.id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("negative.score").alias("negative_score"),
    )
