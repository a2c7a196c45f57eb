"""Near-duplicate documents by HyperMinHash.

Each document's distinct shingle hashes are dealt into registers by their high bits. A register keeps the leading
zeros of its smallest hash and the bits that follow them (six and 26 bits), four bytes instead of the eight of a hash. These registers
are what is stored, what bands of four find candidates by, and what estimates are made of. With ten bits instead of 26 a set of three
shingles, whose bands repeat one or two registers, shared a band with 0.05 of 40,000 others by chance; with 18 with 0.0002, with 26 with none.

Small sets leave registers empty. In a band an empty register takes the value and number of another one: of those
that a fixed random sequence of this register's own visits, the first that is filled. Two sets see the same value
there as often as at a filled register, so all sizes are banded alike, by one kind of key.

1. Documents with equal shingle sets become one class, represented by the smallest doc_id.
2. Representatives that agree on all registers of a band meet in a bucket. Each is compared with two pivots of its
   bucket, the smallest and the greatest id: first the collision-corrected estimate of the registers must be within
   five standard errors of the threshold, then the full sets are compared. Links found so give components.
3. A bucket of more than three members that still lie in different components may hide a link between two of them
   that neither pivot has. Its members meet one more pivot, ``TURNS`` times at most, drawn by a hash among members and met only
   by those of other components: documents made from one template, of which each is linked with some others, grow together so.
4. The members of buckets that still lie apart go on to an exact join: every document's shingles in the
   order of their frequency among these documents, of which the first n - ceil(0.75 n) + 1 must hold one of any
   partner's, and so early that enough can follow in both. Pairs of different components for which sizes and places
   allow a link, and that pass the estimate, are compared in full. A shingle that all members of a group share comes
   late in the order, so groups that share much and link little give few pairs. Of each shingle the commonest component's
   members meet only those of others, not each other.

Nothing is gathered by bucket or cluster: candidates are pairs, at most two for each member and bucket in step 2, one in each turn of step 3,
and full sets are sent to pairs. The set of a pivot that many documents have is sent in as many copies as there are
``PIVOT_ROWS`` of them, and each copy serves a part. Step 4 compares only documents that the pivots left apart.

With 40 bands of 4 registers a pair at similarity 0.75 misses all buckets with probability of about 1e-6, at
0.8 with 5e-9. Unrelated documents share a band with probability 1e-13 or less.

Results of edge cases. Null and blank texts have an empty set (n_shingles 0) and are linked with nothing, as are rows
whose doc_id is null (component null, kept). Rows that repeat a doc_id with the same text count as one document; with
different texts the id has the links of all of them. An empty table gives an empty result. Ties: of equal sets the
smallest doc_id stays. Texts of any length are read whole. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import map_batches, mix, slices, utf8, windows, word_hashes
from .components import components
from .tables import written

BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
#: Bits of the mantissa of a register; the code of one without a shingle.
MANTISSA = 26
EMPTY = (1 << 32) - 1
#: Turns of further pivots in buckets whose members lie apart.
TURNS = 1
#: Pairs that one copy of a pivot's set serves.
PIVOT_ROWS = 128
_EDGES = np.array([(i << 64) // REGISTERS for i in range(REGISTERS)], dtype=np.uint64)
#: The registers that each register visits in turn when it is empty; any filled one is found, as every row ends with all of them.
_VISITS = np.random.default_rng(9).permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; a shorter text is one shingle."""
    words = utf8(text).lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    return np.unique(windows(h, k)) if len(h) >= k else mix(windows(h, len(h)) + np.uint64(len(h)))


def registers(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, whether there is one) of a sorted set: up to 63 leading zeros of each register's smallest hash in the high
    six bits of a code, the bits after the first one in the others."""
    at = np.searchsorted(shingles, _EDGES)
    there = at < np.append(at[1:], len(shingles))
    # The position within the register as a fraction of its width is uniform again.
    place = ((shingles[at[there]] - _EDGES[there]) >> np.uint64(8)).astype(np.float64) / (2.0**56 / REGISTERS)
    fraction, exponent = np.frexp(np.clip(place, 2.0**-63, 1 - 2.0**-53))
    codes = np.zeros(REGISTERS, np.uint64)
    codes[there] = np.clip(-exponent, 0, 63).astype(np.uint64) << np.uint64(MANTISSA) | ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.uint64)
    return codes, there


def stored(codes: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Four bytes a register."""
    return np.where(there, np.minimum(codes, EMPTY - 1), EMPTY).astype(np.uint32)


def band_keys(codes: np.ndarray, there: np.ndarray) -> np.ndarray:
    """One key for each band of the registers, empty ones filled from others."""
    source = np.arange(REGISTERS)
    gaps = np.flatnonzero(~there)
    if len(gaps):
        visits = _VISITS[gaps]
        source[gaps] = visits[np.arange(len(gaps)), there[visits].argmax(axis=1)]
    values = (codes[source] * np.uint64(256) + source.astype(np.uint64)).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in values.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def corrected(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of stored register rows ``a`` and ``b`` of sets of sizes n and m: Jaccard estimates, their standard error at 0.75,
    and the number of unequal registers.

    Of the registers filled in either set the equal ones are counted, less those expected to be equal by
    chance among the unequal ones: two independent minima share a code with probability about
    0.17 * 2**-mantissa * 4nm/(n+m)**2.
    """
    filled = (a != EMPTY) | (b != EMPTY)
    total = np.maximum(filled.sum(axis=-1), 1)
    same = ((a == b) & filled).sum(axis=-1)
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4.0 * n * m / np.maximum(n + m, 1) ** 2
    return np.maximum(0.0, (same / total - chance) / (1 - chance)), np.sqrt(0.75 * 0.25 / total), total - same


def alike(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether estimates and sizes allow similarity ``least``.

    An unequal register has a shingle of one set alone as its smallest, and each such shingle lies in one register: sets
    that similar have at most (n + m)(1 - least)/(1 + least) of them, which decides small sets without any error.
    """
    estimate, error, unequal = corrected(a, b, n, m)
    fits = np.minimum(n, m) >= least * np.maximum(n, m)
    return fits & (estimate >= least - 5 * error) & (unequal <= (n + m) * (1 - least) / (1 + least) + 1e-9)


def sketches(docs: DataFrame, k: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, set_key (null for an empty set), registers and keys of bands.

    A set of one or two shingles is that similar only to its equals, so it has no keys."""

    def sketch(batches):
        for b in slices(batches):
            rows = []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, k)
                if not len(s):
                    rows.append((0, None, None, None))
                    continue
                codes = registers(s)
                rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), stored(*codes).tobytes(), band_keys(*codes) if len(s) > 2 else ()))
            yield [b.column("doc_id"), *(list(c) for c in zip(*rows, strict=True))]

    return map_batches(docs.select("doc_id", "text"), sketch, "doc_id bigint, n_shingles bigint, set_key binary, registers binary, keys array<bigint>")


def _both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` (a, b, parts) with the other columns of ``table`` (rep, ...) for a, and for b under names that begin with
    ``other_``. A row of ``b`` is sent in ``parts`` copies, each for a part of its pairs."""
    rest = [c for c in table.columns if c != "rep"]
    part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    copies = pairs.groupBy("b").agg(F.max("parts").alias("parts"))
    spread = table.withColumnRenamed("rep", "b").join(copies, "b").select("b", *(F.col(c).alias(f"other_{c}") for c in rest), F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"))
    mine = pairs.join(table.withColumnRenamed("rep", "a"), "a").withColumn("part", part)
    return mine.join(spread, ["b", "part"]).drop("part")


def similar_pairs(pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the ``pairs`` (a, b, parts) that are linked: first by their registers, then by their full sets."""

    def estimate(batches):
        for b in batches:
            one, two = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, REGISTERS) for c in ("registers", "other_registers"))
            n, m = (b.column(c).to_numpy().astype(float) for c in ("n_shingles", "other_n_shingles"))
            near = pa.array(alike(one, two, n, m, percent / 100))
            yield [b.column(c).filter(near) for c in ("a", "b", "parts")]

    likely = written(map_batches(_both(pairs, reps.select("rep", "n_shingles", "registers")), estimate, "a bigint, b bigint, parts bigint"), "likely")

    def compare(batches):
        for b in slices(batches, 512):
            one, two = ([np.frombuffer(x, np.uint64) for x in b.column(c).to_pylist()] for c in ("shingles", "other_shingles"))
            linked = [100 * c >= percent * (len(x) + len(y) - c) for x, y in zip(one, two, strict=True) for c in (len(np.intersect1d(x, y, assume_unique=True)),)]
            linked = pa.array(linked, pa.bool_())
            yield [b.column("a").filter(linked), b.column("b").filter(linked)]

    needed = written(likely.select(F.col("a").alias("rep")).union(likely.select("b")).distinct(), "needed")
    return written(map_batches(_both(likely, full_sets(docs, needed, k)), compare, "a bigint, b bigint"), "links")


def full_sets(docs: DataFrame, reps: DataFrame, k: int, packed: bool = True) -> DataFrame:
    """(rep, shingles) of the documents ``reps``, from their whole texts, as bytes or as an array; of rows that repeat an id one
    for each text."""

    def sets(batches):
        for b in slices(batches, 128):
            found = [shingle_set(t, k) for t in b.column("text").to_pylist()]
            if packed:
                yield [b.column("rep"), [s.tobytes() for s in found]]
            else:
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield [b.column("rep"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))]

    members = docs.select(F.col("doc_id").alias("rep"), "text").join(reps, "rep")
    return map_batches(members.select("rep", "text"), sets, "rep bigint, shingles " + ("binary" if packed else "array<bigint>"))


def of_buckets(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` (bucket, rep, members, ...) of the ``buckets`` (bucket, members), each sent in a copy for every ``PIVOT_ROWS`` of its
    members, so that a large one is no single task."""
    parts = F.ceil(F.col("members") / PIVOT_ROWS)
    copied = buckets.select("bucket", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("copy"))
    return rows.withColumn("copy", F.pmod(F.xxhash64("rep"), parts).cast("int")).join(copied, ["bucket", "copy"]).drop("copy")


def candidate_pairs(meets: DataFrame) -> DataFrame:
    """(a, b, parts) from members of buckets (rep, members, least, greatest): each with its bucket's two pivots."""
    pivots = F.explode(F.array("least", "greatest")).alias("b")
    pairs = meets.select(F.col("rep").alias("a"), pivots, "members", "least", "greatest").where("a <> b and not (a = least and b = greatest)")
    return pairs.groupBy("a", "b").agg(F.ceil(F.max("members") / PIVOT_ROWS).alias("parts"))


def apart(meets: DataFrame, state: DataFrame) -> DataFrame:
    """(bucket, rep, members, component) of the buckets of more than three members whose members lie in different components."""
    split = meets.where("members > 3").select("bucket", "rep", "members").join(state, "rep")
    buckets = split.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.first("members").alias("members")).where("low < high").select("bucket", "members")
    return of_buckets(split, buckets).select("bucket", "rep", "members", "component")


def drawn_pairs(split: DataFrame, turn: int) -> DataFrame:
    """(a, b, parts): members of ``apart`` buckets with the one that a hash draws, where it is of another component."""
    drawn = split.groupBy("bucket").agg(F.min_by(F.struct("rep", "component"), F.xxhash64("rep", F.lit(turn))).alias("p"), F.first("members").alias("members"))
    parts = F.ceil(F.col("members") / PIVOT_ROWS)
    copied = drawn.select("bucket", "p", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("copy"))
    met = split.withColumn("copy", F.pmod(F.xxhash64("rep"), parts).cast("int")).join(copied, ["bucket", "copy"])
    pairs = met.where("component <> p.component").select(F.col("rep").alias("a"), F.col("p.rep").alias("b"), "members")
    return pairs.groupBy("a", "b").agg(F.ceil(F.max("members") / PIVOT_ROWS).alias("parts"))


def joined(state: DataFrame, links: DataFrame) -> DataFrame:
    """``state`` (rep, component) after more links: only the components that these touch are gone through again."""
    ends = links.join(state.select(F.col("rep").alias("a"), F.col("component").alias("x")), "a").join(state.select(F.col("rep").alias("b"), F.col("component").alias("y")), "b")
    merged = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("least"))
    return written(state.join(merged, "component", "left").select("rep", F.coalesce("least", "component").alias("component")), "state")


def pairs_left(meets: DataFrame, state: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Pairs (a, b, parts) of different components (``state``: rep, component) that buckets of more than three members may
    hide; None if there is no such bucket."""
    left = written(apart(meets, state).select("rep", "component").distinct(), "left")
    if left.isEmpty():
        return None

    shingles = full_sets(docs, left.select("rep"), k, packed=False).join(left, "rep").select("rep", "component", F.explode("shingles").alias("token"))
    shingles = written(shingles, "tokens")
    held = shingles.groupBy("token", "component").agg(F.count("*").alias("n"))
    common = held.groupBy("token").agg(F.sum("n").alias("n"), (F.count("*") > 1).alias("across"), F.max_by("component", F.struct("n", "component")).alias("major")).where("n > 1")
    ranked = shingles.join(common, "token", "left").groupBy("rep", "component").agg(F.count("*").alias("size"), F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "token", "across", "major"))).alias("order"))
    first = F.slice("order", F.lit(1), (F.col("size") - F.ceil(F.col("size") * percent / 100) + 1).cast("int"))
    prefix = written(ranked.select("rep", "component", "size", F.posexplode(first).alias("place", "t")).where("t.across").select("rep", "component", "size", "place", "t.token", "t.n", (F.col("component") == F.col("t.major")).alias("major")), "prefixes")
    # Of two linked sets the common shingles are ``least`` or more, so after their first common one each has that many less one;
    # the smaller set then has it in a shorter prefix.
    small = prefix.where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * 2 * percent / (100 + percent)))
    x, y = (df.select("token", "n", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "component", "size", "place", "major"))) for df, s in ((small, "x"), (prefix, "y")))
    least = F.ceil((F.col("size_x") + F.col("size_y")) * percent / (100 + percent))
    smaller = (F.col("size_x") < F.col("size_y")) | ((F.col("size_x") == F.col("size_y")) & (F.col("rep_x") < F.col("rep_y")))
    near = smaller & (100 * F.col("size_x") >= percent * F.col("size_y")) & (F.col("component_x") != F.col("component_y")) & (F.col("place_x") <= F.col("size_x") - least) & (F.col("place_y") <= F.col("size_y") - least)
    met = x.where("not major_x").join(y.drop("n"), "token").where(near).unionByName(x.where("major_x").join(y.drop("n").where("not major_y"), "token").where(near))
    return met.groupBy(F.col("rep_y").alias("a"), F.col("rep_x").alias("b")).agg(F.ceil(F.max("n") / PIVOT_ROWS).alias("parts"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    sketch = written(sketches(docs, k), "sketches")
    known = sketch.where("doc_id is not null and n_shingles > 0")
    reps = written(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.first("keys").alias("keys")), "reps")

    bands = reps.select(F.explode("keys").alias("bucket"), "rep")
    shared = bands.groupBy("bucket").agg(F.count("*").alias("members"), F.min("rep").alias("least"), F.max("rep").alias("greatest"), F.expr("bit_xor(xxhash64(rep))").alias("who")).where("members > 1")
    shared = shared.groupBy("members", "least", "greatest", "who").agg(F.min("bucket").alias("bucket")).drop("who")  # of buckets with the same members, one
    meets = written(bands.join(shared, "bucket"), "meets")

    links = similar_pairs(written(candidate_pairs(meets), "pairs"), reps, docs, k, percent)
    found = components(links).select(F.col("node").alias("rep"), "component")
    state = written(meets.select("rep").distinct().join(found, "rep", "left").select("rep", F.coalesce("component", "rep").alias("component")), "state")
    for turn in range(TURNS):
        split = written(apart(meets, state), "apart")
        if split.isEmpty():
            break
        more = similar_pairs(written(drawn_pairs(split, turn), "pairs"), reps, docs, k, percent)
        if more.isEmpty():
            break
        state = joined(state, more)
    left = pairs_left(meets, state, reps, docs, k, percent)
    if left is not None:
        more = similar_pairs(written(left, "pairs"), reps, docs, k, percent)
        if not more.isEmpty():
            state = joined(state, more)

    final = reps.select("set_key", "rep").join(state, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("least"))
    out = sketch.select("doc_id", "n_shingles", "set_key").join(final, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
