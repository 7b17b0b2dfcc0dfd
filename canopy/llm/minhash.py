"""Near duplicates by circulant MinHash with exact verification.

A document's set holds its distinct runs of ``shingle_words`` words.  Two fixed
permutations make a whole signature: the first scatters a shingle to a place of
a large ring, the second numbers the places; coordinate ``k`` is the least
number found ``k`` places further on.  So all coordinates of a shingle lie side
by side, and a signature is a minimum over slices of one array.  Documents
that agree in a band of ``rows`` coordinates are candidates; with 36 bands of 5
coordinates a pair at similarity 0.8 is missed less than once in a million.

Large groups never become all pairs:

* equal sets are one class, found by a digest of the set;
* in every bucket the classes are compared with one of them, the one that
  shares most buckets with others (the text the copies were made of), then with
  a second one of another component;
* what is left are pairs of one bucket without those two that are not yet linked
  through a common class; all of them are compared, so no link is lost: classes
  with the same most frequent leader as exact tiles of sets that return a
  forest of links, others pair by pair.

Links are confirmed on the full word sets of both texts.

Defined results: a null text or one without words has an empty set and is
linked with nothing; fewer words than a shingle are one shingle; a null id is
linked with nothing, its component is null and it is kept; rows of one id are
each linked by their own text, and where such an id is the smallest of several
sets these are numbered, in order of id, instead of named by it; an empty table gives an empty table; other
columns of the input are ignored by ``near_duplicates`` and kept by
``drop_near_duplicates``, where also of rows equal in id and set one stays, and
of an id's rows those go whose own text is a copy.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import arrow_map, stored
from canopy.llm.components import components
from canopy.operators.prepare import row_index

RING_BITS = 20
SHINGLE_WORDS = 5
#: Word hashes a Python worker keeps between slices; beyond it, it starts again.
CACHED_WORDS = 120_000
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case (bytes split at space and 0x09 to 0x0D, and know no other case)."""
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


HASHES = WordHashes()


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX_A
    h = (h ^ (h >> np.uint64(29))) * MIX_B
    return h ^ (h >> np.uint64(32))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words, ascending; all words as one run if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([HASHES[w] for w in words], np.uint64)
    n = max(1, len(h) - size + 1)
    run = np.full(n, np.uint64(min(size, len(h))))
    for k in range(min(size, len(h))):
        run = scrambled(run ^ h[k : k + n])
    return np.unique(run)


@lru_cache(maxsize=4)
def ring_slices(coordinates: int, seed: int) -> np.ndarray:
    """Row p: the numbers of the places p, p + 1, ... of the ring."""
    numbers = np.random.Generator(np.random.PCG64(seed)).permutation(1 << RING_BITS).astype(np.uint32)
    ring = np.concatenate([numbers, numbers[:coordinates]])
    return np.lib.stride_tricks.sliding_window_view(ring, coordinates)


def signature(shingles: np.ndarray, coordinates: int, seed: int) -> np.ndarray:
    slices = ring_slices(coordinates, seed)
    places = (scrambled(shingles + np.uint64(seed)) >> np.uint64(64 - RING_BITS)).astype(np.int64)
    out = slices[places[:512]].min(axis=0)
    for at in range(512, len(places), 512):  # bounded memory for very long texts
        np.minimum(out, slices[places[at : at + 512]].min(axis=0), out=out)
    return out


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(bands, -1).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64) * MIX_B
    for k in range(rows.shape[1]):
        h = scrambled(h ^ rows[:, k])
    return h.view(np.int64)


def set_digests(sets: list[np.ndarray]) -> dict[str, list[int]]:
    """``s1, s2``: the two halves of the 128-bit digest of each set."""
    digests = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
    halves = {"s1": slice(8), "s2": slice(8, None)}
    return {name: [int.from_bytes(d[half], "big", signed=True) for d in digests] for name, half in halves.items()}


def signatures(df: DataFrame, id_col: str, text_col: str, shingle_words: int, bands: int, rows: int, seed: int) -> DataFrame:
    """``id, n`` (set size), ``s1, s2`` (128-bit digest of the set) and ``bands``."""

    def measure(given):
        sets = [shingle_hashes(words_of(t), shingle_words) for t in given[text_col]]
        yield {
            "id": given[id_col],
            "n": [len(s) for s in sets],
            **set_digests(sets),
            "bands": [band_hashes(signature(s, bands * rows, seed), bands).tolist() if len(s) else [] for s in sets],
        }

    return arrow_map(df, [id_col, text_col], measure, "id long, n long, s1 long, s2 long, bands array<long>")


def digested(texts: DataFrame, shingle_words: int) -> DataFrame:
    """``id, text`` and the digest ``s1, s2`` of the text's set."""

    def measure(given):
        sets = [shingle_hashes(words_of(t), shingle_words) for t in given["text"]]
        yield {"id": given["id"], "text": given["text"], **set_digests(sets)}

    return arrow_map(texts, ["id", "text"], measure, "id long, text string, s1 long, s2 long")


def linked(pairs: DataFrame, texts: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """The pairs (``a, b``: class ids) whose full sets reach ``percent`` of their union."""
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b")

    def full_set(words: list[bytes]) -> set:
        if len(words) < shingle_words:
            return {tuple(words)}
        return set(zip(*[words[k:] for k in range(shingle_words)], strict=False))

    def confirm(given):
        found = {"a": [], "b": []}
        last, last_set = None, set()  # pairs of one b follow each other
        for x, y, text_x, text_y in zip(given["a"], given["b"], given["text_a"], given["text_b"], strict=True):
            if last is None or text_y != last:
                last, last_set = text_y, full_set(words_of(text_y))
            other = full_set(words_of(text_x))
            common = len(other & last_set)
            if 100 * common >= percent * (len(other) + len(last_set) - common):
                found["a"].append(x)
                found["b"].append(y)
        yield found

    return arrow_map(both, ["a", "b", "text_a", "text_b"], confirm, "a long, b long", slice_rows=64)


def classes_and_components(
    df: DataFrame, *, id_col, text_col, shingle_words: int, percent: int, bands: int, rows: int, seed: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows, the classes (``s1, s2, rep, first_id``) and the components of the linked classes (``id, component``).

    ``rep`` names a class: its smallest id, or its number in order of these
    where one id is the smallest of several sets.
    """
    signed = stored(signatures(df, id_col, text_col, shingle_words, bands, rows, seed), "minhash-signatures")
    usable = signed.where("id is not null and n > 0")
    groups = usable.groupBy("s1", "s2").agg(F.min("id").alias("first_id"), F.min_by("bands", "id").alias("bands"), F.first("n").alias("n"))
    classes = stored(groups.withColumn("rep", F.col("first_id")), "minhash-classes")
    numbered = not classes.groupBy("first_id").count().where("count > 1").isEmpty()
    if numbered:
        numbers = row_index(classes.select("first_id", "s1", "s2"), "first_id", "rep").drop("first_id")
        classes = stored(classes.drop("rep").join(numbers, ["s1", "s2"]), "minhash-classes")
    entries = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    entries = stored(entries.join(sizes, "bucket"), "minhash-buckets")
    # how many others a class meets, over all its buckets
    weight = entries.groupBy("rep").agg(F.sum("m").alias("weight"))
    entries = entries.drop("m").join(weight, "rep")
    entries = stored(entries.join(leader_of(entries), "bucket"), "minhash-entries")
    # texts of the classes that share a bucket with another one
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    if numbered:
        # of an id's rows the one whose set is the class's own
        met = classes.join(weight, "rep", "left_semi").select(F.col("first_id").alias("id"), "s1", "s2", "rep")
        texts = digested(texts.join(met.select("id").distinct(), "id", "left_semi"), shingle_words)
        texts = texts.join(met, ["id", "s1", "s2"]).select(F.col("rep").alias("id"), "text").dropDuplicates(["id"])
    else:
        texts = texts.join(weight.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"])
    texts = stored(texts, "minhash-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return stored(linked(pairs, texts, shingle_words, percent), "minhash-links")

    home = entries.groupBy("rep", "leader").count().groupBy("rep")
    home = home.agg(F.max(F.struct("count", (-F.col("leader")).alias("minus"))).alias("x"))
    home = stored(home.select("rep", (-F.col("x.minus")).alias("home")), "minhash-homes")

    links = confirmed(star(entries, percent))
    # in buckets of several groups, every class against the best of another group than the leader's
    group = stored(grouped(links, home), "minhash-groups")
    spread = stored(mixed_buckets(entries, group), "minhash-spread")
    first = spread.where("rep = leader").select("bucket", F.col("component").alias("first"))
    others = spread.join(first, "bucket").where("component <> first").drop("leader", "leader_n")
    seconds = leader_of(others)
    links = links.union(confirmed(star(spread.drop("leader", "leader_n").join(seconds, "bucket"), percent)))
    # what is left: pairs of one bucket in different groups without one of the two
    rest = spread.where("rep <> leader").drop("component").join(seconds.select("bucket", F.col("leader").alias("second")), "bucket")
    rest = mixed_buckets(rest.where("rep <> second").drop("second"), grouped(links, home))
    rest = stored(rest.join(home, "rep").select("bucket", "rep", "n", "component", "home"), "minhash-rest")
    tiled = stored(linked_tiles(rest, texts, shingle_words, percent), "minhash-links")
    links = links.union(tiled).union(confirmed(between_homes(rest, percent)))
    found = components(links)
    if numbered:  # numbers follow the ids, so the least number of a component stands for its smallest id
        found = found.join(classes.select(F.col("rep").alias("component"), "first_id"), "component")
        found = found.select("id", F.col("first_id").alias("component"))
    return signed, classes.select("s1", "s2", "rep", "first_id"), found


def grouped(links: DataFrame, home: DataFrame) -> DataFrame:
    """``id, component``: of each linked class one class it is linked with, its home if it can be.

    Not the whole components, but classes of one label are linked through
    it, which is all that comparisons may be left out for.
    """
    named = links.join(home.withColumnRenamed("rep", "a"), "a")
    chosen = named.groupBy("a").agg(F.max(F.struct((F.col("b") == F.col("home")).alias("is_home"), (-F.col("b")).alias("minus"))).alias("x"))
    chosen = chosen.select(F.col("a").alias("id"), (-F.col("x.minus")).alias("component"), F.col("x.is_home"))
    # a class that leads its own home keeps its own label, so that those it leads share it
    own = home.where("rep = home").select(F.col("rep").alias("id"))
    return chosen.join(own, "id", "left_anti").select("id", "component")


def near_sizes(a: str, b: str, percent: int):
    """False for sets whose sizes alone rule the similarity out."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def star(members: DataFrame, percent: int) -> DataFrame:
    """Every class with the leader of its bucket."""
    met = members.where((F.col("rep") != F.col("leader")) & near_sizes("n", "leader_n", percent))
    return met.select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct()


def leader_of(members: DataFrame) -> DataFrame:
    """``bucket, leader, leader_n``: of every bucket the class of most weight, of equal ones the smallest id."""
    first = members.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"), "n")).alias("x"))
    return first.select("bucket", (-F.col("x.minus")).alias("leader"), F.col("x.n").alias("leader_n"))


def between_homes(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket with different homes (each class's most frequent leader) and components."""
    side = rest.select("bucket", "home").distinct()
    meet = side.join(side.select("bucket", F.col("home").alias("other")), "bucket").where("home < other")
    left = rest.select("bucket", "home", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"))
    right = rest.select(
        "bucket", F.col("home").alias("other"), F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b")
    )
    pairs = meet.join(left, ["bucket", "home"]).join(right, ["bucket", "other"])
    pairs = pairs.where(near_sizes("n_a", "n_b", percent) & (F.col("c_a") != F.col("c_b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_tiles(rest: DataFrame, texts: DataFrame, shingle_words: int, percent: int, tile: int = 256, tile_shingles: int = 400_000) -> DataFrame:
    """Links among classes of one home, exact, as a forest.

    Only classes outside the home's largest group are open.  Open ones
    and all are cut into parts of about ``tile`` classes and ``tile_shingles``
    shingles; a tile is one open part against one part of all, whose
    intersections are counted by a matrix product.  A tile returns at most
    as many links as it has classes, whatever the number of linked pairs.
    """
    own = rest.select("rep", "n", "component", "home").distinct()
    largest = own.groupBy("home", "component").count().groupBy("home")
    largest = largest.agg(F.max(F.struct("count", "component")).alias("x")).select("home", F.col("x.component").alias("main"))
    own = own.join(largest, "home").withColumn("open", F.col("component") != F.col("main"))

    def parts(which):
        of = F.when(which, F.lit(1)), F.when(which, F.col("n"))
        return F.greatest(F.ceil(F.count(of[0]) / tile), F.ceil(F.coalesce(F.sum(of[1]), F.lit(0)) / tile_shingles))

    counts = own.groupBy("home").agg(parts(F.col("open")).alias("open_parts"), parts(F.lit(True)).alias("all_parts"))
    own = own.join(counts.where("open_parts > 0"), "home")
    draw = F.xxhash64("rep")
    every = own.select(
        "home", "rep", "component", F.lit(0).alias("side"), F.pmod(draw, "all_parts").alias("j"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("open_parts") - 1)).alias("i"),
    )
    opened = own.where("open").select(
        "home", "rep", "component", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_parts") - 1)).alias("j"),
        F.pmod(draw, "open_parts").alias("i"),
    )
    rows = every.unionByName(opened).withColumn("tile", F.xxhash64("home", "i", "j"))
    rows = rows.join(texts.withColumnRenamed("id", "rep"), "rep")
    ordered = rows.select("tile", "side", "rep", "component", "text").repartition("tile").sortWithinPartitions("tile", "side", "rep")

    def compare(batches):
        def links_of(group):
            sides, reps, components_, texts_ = (np.array(x) if k < 3 else x for k, x in enumerate(zip(*group, strict=True)))
            sets = [shingle_hashes(words_of(t), shingle_words) for t in texts_]
            sizes = np.array([len(x) for x in sets], np.int64)
            a, b = np.flatnonzero(sides == 1), np.flatnonzero(sides == 0)
            common = intersections([sets[k] for k in a], [sets[k] for k in b])
            near = 100 * common >= percent * (sizes[a][:, None] + sizes[b][None, :] - common)
            near &= components_[a][:, None] != components_[b][None, :]
            parent: dict[int, int] = {}

            def root(x):
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for x, y in zip(reps[a[np.nonzero(near)[0]]].tolist(), reps[b[np.nonzero(near)[1]]].tolist(), strict=True):
                if root(x) != root(y):
                    parent[root(x)] = root(y)
                    yield x, y

        def give(group):
            found = list(links_of(group)) if any(g[0] == 1 for g in group) else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        held, key = [], None
        for batch in batches:
            for tile_key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tile_key != key and held:
                    yield give(held)
                    held = []
                key = tile_key
                held.append(row)
        if held:
            yield give(held)

    return ordered.mapInArrow(compare, "a long, b long")


def intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b``."""
    out = np.zeros((len(a), len(b)), np.float32)
    if not a or not b:
        return out.astype(np.int64)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    shared = np.intersect1d(flat_a, flat_b)
    keep_a, keep_b = np.isin(flat_a, shared), np.isin(flat_b, shared)
    col_a, col_b = np.searchsorted(shared, flat_a[keep_a]), np.searchsorted(shared, flat_b[keep_b])
    row_a, row_b = row_a[keep_a], row_b[keep_b]
    for at in range(0, len(shared), width):
        x, y = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        for m, row, col in ((x, row_a, col_a), (y, row_b, col_b)):
            inside = (col >= at) & (col < at + width)
            m[row[inside], col[inside] - at] = 1
        out += x @ y.T
    return out.astype(np.int64)


def mixed_buckets(entries: DataFrame, found: DataFrame) -> DataFrame:
    """The entries, with their label (``component``), of buckets that hold several labels."""
    own = entries.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    own = own.withColumn("component", F.coalesce("component", "rep"))  # unlinked: a component of its own
    several = own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return own.join(several.select("bucket"), "bucket", "left_semi")


def near_duplicates(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = 80,
    bands: int = 36,
    rows: int = 5,
    seed: int = 42,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` and the digest ``s1, s2`` of the set, for every document."""
    signed, classes, found = classes_and_components(
        df, id_col=id_col, text_col=text_col, shingle_words=shingle_words, percent=percent, bands=bands, rows=rows, seed=seed
    )
    # linked classes only: the others are their own component
    moved = found.select(F.col("id").alias("rep"), "component")
    final = classes.join(moved, "rep", "left").select("s1", "s2", F.coalesce("component", "first_id").alias("component"))
    out = signed.select("id", "n", "s1", "s2").join(final, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        "s1",
        "s2",
    )


def drop_near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` without the documents that are not the smallest id of their group."""
    judged = stored(near_duplicates(df, id_col=id_col, text_col=text_col, **how), "minhash-judged")
    # an id goes as a whole, or where its rows differ in that, its rows of some texts
    own = judged.where("doc_id is not null").groupBy(F.col("doc_id").alias("id"))
    own = own.agg(F.max("kept").alias("some_kept"), F.min("kept").alias("all_kept"))
    gone = own.where(~F.col("some_kept")).select(F.col("id").alias(id_col))
    rows = df.join(gone, id_col, "left_anti").select(*df.columns)
    differ = own.where("some_kept and not all_kept").select("id")
    if not differ.isEmpty():
        texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(differ, "id", "left_semi").distinct()
        copies = judged.where(~F.col("kept")).select(F.col("doc_id").alias("id"), "s1", "s2").distinct()
        copies = digested(texts, how.get("shingle_words", SHINGLE_WORDS)).join(copies, ["id", "s1", "s2"], "left_semi")
        copies = stored(copies.select(F.col("id").alias(id_col), F.col("text").alias(text_col)), "minhash-copies")
        rows = rows.join(copies, [id_col, text_col], "left_anti").select(*df.columns)
    twice = judged.where("kept and doc_id is not null").groupBy("doc_id", "s1", "s2").count().where("count > 1")
    twice = twice.select(F.col("doc_id").alias(id_col)).distinct()
    if twice.isEmpty():
        return rows
    once = rows.join(twice, id_col, "left_semi").select(*df.columns).dropDuplicates([id_col, text_col])
    return rows.join(twice, id_col, "left_anti").select(*df.columns).unionByName(once)
