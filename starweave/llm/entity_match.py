"""Matching entities of two sources that share no key, from noisy attributes.

1. Records become nodes of a graph: record - location token - record, and record - attribute token - record.
   A first-source record has the sky cell it lies in, a second-source record every cell within its reach, so
   places within reach share a cell; cells that only one source has lead nowhere and are left out. Magnitude, colour
   and parallax give attribute tokens, each source with its own scale and its own tokens, and one for a missing value.
2. Random walks: from every record WALKS walks of STEPS steps, each through a location or
   an attribute token the record has to another record that has it. The tokens of the visited records
   are the sentences on which skip-gram vectors are trained, all of them, in blocks whose vectors are averaged. So tokens of
   both sources that stand for the same property come together. A location has two names out of a bounded number each, so the model's size does
   not grow with the data and different places still have different vectors.
3. A record's vector in a cell is the weighted sum of its tokens' vectors. Blocking: tables of hyperplanes, the bucket
   of a record is the signs of its vector; the bits grow with the logarithm of the records, and the tables
   with them, so that a pair whose signs agree with probability AGREE each is missed with probability MISS at most.
4. Pairs of one bucket are ranked exactly: separation after proper motion to a common epoch, and magnitude, colour
   and parallax differences; the relation of both sources' magnitudes and colours is fitted to the close pairs of
   the run by least squares, with a gate on the residuals. A record without recorded motion may have moved: its reach is wider.
5. Calibration: the cosines and these differences are binned, agreement patterns are counted over all
   pairs, and an expectation-maximisation fit of matches against non-matches turns each pattern into the
   probability that both are the same thing.

Defined results: a record is its latest non-missing values; records without a place match nothing;
NULL, NaN and infinite values and the stand-in magnitude are missing, and a missing value speaks for
neither side; a record may match several; ties are all kept; an empty side gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.functions.geometry import EPOCH_PRIMARY, EPOCH_SECONDARY, arcsec_of_chord2, chord2, chord_of_arcsec, propagated, unit_vector
from starweave.functions.numeric import finite_or_null
from starweave.operators.latest import latest_values
from starweave.session import discard, free_shuffles, hash_joins, materialise

REACH = 3.0
YEARS = EPOCH_PRIMARY - EPOCH_SECONDARY
#: Motion in arcsec a year that a record without recorded motion may have.
UNRECORDED_MOTION = 2.0
RADIUS = chord_of_arcsec(REACH)
WIDE_RADIUS = chord_of_arcsec(REACH + YEARS * UNRECORDED_MOTION)
EDGE = 8 * RADIUS
#: Names of either kind that a location token is spelled with.
LOCATION_NAMES = 1 << 13
#: Walks from each record, steps of a walk.
WALKS, STEPS = 2, 3
DIMENSIONS = 24
#: Walks of a block (about) and of a step of its descent, steps in a block at least, rounds that share out the blocks.
BLOCK_WALKS, STEP_WALKS, LEAST_STEPS, ROUNDS = 20_000, 200, 100, 2
#: Words drawn against all words of a step, the weight of what is drawn for each word of the window, the rate of descent.
NEGATIVES, NEGATIVE_WEIGHT, RATE = 32, 1.0, 0.05
#: Parts of the vocabulary in which the tasks' vectors are added up.
PARTS = 16
#: Weight of a location in a record's vector, and of each attribute.
LOCATION_WEIGHT, ATTRIBUTE_WEIGHT = 1.0, 0.12
LEAST_BITS, MOST_BITS, SPARED_BITS, AGREE, MISS = 8, 48, 5, 0.94, 1e-3
#: Records of one cell that meet in one task; more are spread over salts.
SALT_ROWS = 10_000
STAND_IN_MAG = 50.0
ATTRIBUTES = ("m", "c", "p")
#: Close pairs from which the relation of magnitudes and colours is fitted, and the gate on residuals in standard deviations.
CLOSE_ARCSEC, GATE, LEAST_PAIRS = 0.5, 2.5, 20

BINS = {
    "sep": (0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 2.5, 3.0, 5.0, 10.0, 20.0),
    "mag": (0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0),
    "colour": (0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75),
    "plx": (0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 6.0, 10.0),
    "cosine": tuple(1 - d for d in (0.06, 0.05, 0.04, 0.03, 0.025, 0.02, 0.015, 0.01, 0.0075, 0.005)),
}
#: The cosine repeats in part what the differences say, so its weight of evidence counts in part.
EVIDENCE = {"cosine": 0.25}


def placed(df: DataFrame) -> DataFrame:
    """Records with a unit vector from their ``ra`` and ``dec``."""
    ok = F.col("ra").isNotNull() & F.col("dec").isNotNull() & (F.abs("dec") <= 90)
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    return df.where(ok).withColumns({"x": x, "y": y, "z": z})


def first_source(df: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """(id, x, y, z, wide, mag, colour, plx, e_plx) of the survey at the common epoch.

    ``near``: cells of the other source. Deliveries placed in none of them are left out before the
    deliveries of a source are merged; those without a place are kept."""
    f = finite_or_null
    if near is not None:
        x, y, z = unit_vector(f("ra_deg"), f("dec_deg"))
        rows = df.withColumn("cell", _cell(x, y, z))
        df = rows.where(F.col("cell").isNotNull()).join(near.select("cell").distinct(), "cell", "left_semi").unionByName(rows.where(F.col("cell").isNull()))
    cols = {"ra": f("ra_deg"), "dec": f("dec_deg"), "g": f("phot_g_mean_mag"), "bp": f("phot_bp_mean_mag"), "rp": f("phot_rp_mean_mag"), "plx": f("parallax"), "e_plx": f("parallax_error")}
    df = placed(latest_values(df, "source_id", cols, "loaded_at"))
    return df.select("id", "x", "y", "z", F.lit(False).alias("wide"), F.col("g").alias("mag"), (F.col("bp") - F.col("rp")).alias("colour"), "plx", "e_plx")


def second_source(df: DataFrame) -> DataFrame:
    """The same columns of the older catalogue, moved to the common epoch; its own magnitudes and colours."""
    f = finite_or_null
    mag = F.when(f("hpmag") < STAND_IN_MAG, F.col("hpmag"))
    cols = {"ra": f("rarad"), "dec": f("derad"), "pmra": f("pmra"), "pmdec": f("pmde"), "mag": mag, "colour": f("b_v"), "plx": f("plx"), "e_plx": f("e_plx")}
    df = latest_values(df, "hip", cols, "loaded_at")
    zero = F.lit(0.0)
    ra, dec = propagated(F.col("ra"), F.col("dec"), F.coalesce("pmra", zero), F.coalesce("pmdec", zero), YEARS)
    wide = F.col("pmra").isNull() | F.col("pmdec").isNull()
    df = placed(df.withColumns({"ra": ra, "dec": dec}))
    return df.select("id", "x", "y", "z", wide.alias("wide"), "mag", "colour", "plx", "e_plx")


def _cell(x: Column, y: Column, z: Column) -> Column:
    """The cell of a place as one number; NULL without a place."""
    return F.when(x.isNotNull() & y.isNotNull() & z.isNotNull(), F.xxhash64(*[F.floor(v / EDGE).cast("int") for v in (x, y, z)]))


#: Steps of a packed place, 21 bits for each coordinate; a strip has so many bits of steps of the first coordinate.
PACK = 1 << 20
STRIP_BITS = 12


def _packed() -> Column:
    x, y, z = (F.floor((F.col(v) + 1.0) * float(PACK - 1)).cast("bigint") for v in "xyz")
    return F.shiftleft(x, 42).bitwiseOR(F.shiftleft(y, 21)).bitwiseOR(z)


def _unpacked(c: str) -> list[Column]:
    mask = F.lit((1 << 21) - 1).cast("bigint")
    return [F.shiftright(F.col(c), k).bitwiseAND(mask).cast("double") / float(PACK - 1) for k in (42, 21, 0)]


def cells_within_reach(df: DataFrame) -> DataFrame:
    """(id, cell, place, wide, m, c, p): every cell that holds places within reach of the record."""
    radius = F.when(F.col("wide"), WIDE_RADIUS).otherwise(RADIUS)
    for v in "xyz":
        df = df.withColumn(f"c{v}", F.explode(F.sequence(*[F.floor((F.col(v) + s * radius) / EDGE).cast("int") for s in (-1, 1)])))
    return df.select("id", F.xxhash64("cx", "cy", "cz").alias("cell"), _packed().alias("place"), "wide", *_bins())


def _bins() -> list[Column]:
    """Magnitude, colour and parallax tokens as small numbers, on the source's own scale."""
    parallax = F.log2(F.when(F.col("plx") > 0, F.col("plx")))
    return [F.floor(v).cast("smallint").alias(n) for v, n in ((F.col("mag") * 2, "m"), (F.col("colour") * 4, "c"), (parallax, "p"))]


def shared_tokens(first: DataFrame, second: DataFrame) -> DataFrame:
    """(src, id, cell, place, wide, m, c, p, n) for the cells with records of both sources; n is how many they hold."""
    own = first.select(F.lit(0).alias("src"), "id", _cell(F.col("x"), F.col("y"), F.col("z")).alias("cell"), _packed().alias("place"), "wide", *_bins())
    rows = own.unionByName(cells_within_reach(second).withColumn("src", F.lit(1)))
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("src").alias("n_second")).where((F.col("n_second") > 0) & (F.col("n_second") < F.col("n"))).drop("n_second")
    return rows.join(cells, "cell")


#: A missing bin, and the bits that a bin takes in a word's code.
NO_BIN, BIN_BITS = 1 << 16, 17


def _packed_bins() -> Column:
    """The source and the three bins of a record as one number."""
    packed = F.col("src").cast("bigint")
    for a in ATTRIBUTES:
        packed = F.shiftleft(packed, BIN_BITS).bitwiseOR(F.coalesce(F.col(a).cast("bigint") + (NO_BIN >> 1), F.lit(NO_BIN).cast("bigint")))
    return packed


def _attribute_codes(packed: Column) -> list[Column]:
    """The codes of a record's attribute words: kind, source and bin."""
    n, mask = len(ATTRIBUTES), F.lit((1 << BIN_BITS) - 1).cast("bigint")
    src = F.shiftright(packed, BIN_BITS * n)
    return [F.shiftleft(src + 2 * k, BIN_BITS).bitwiseOR(F.shiftright(packed, BIN_BITS * (n - 1 - k)).bitwiseAND(mask)) for k in range(n)]


def _spelled(code: int) -> str:
    """The attribute word of a code."""
    kind, value = code >> BIN_BITS, code & ((1 << BIN_BITS) - 1)
    return f"{ATTRIBUTES[kind >> 1]}{kind & 1}_{'none' if value == NO_BIN else value - (NO_BIN >> 1)}"


def graph(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, tokens): (node, at, crowd, bins) of every record in a cell, and (token, seats) of the attribute tokens, which are
    bounded by the bins. ``crowd`` is the number of nodes in the cell."""
    nodes = rows.select(F.xxhash64("src", "id", "cell").alias("node"), F.col("cell").alias("at"), F.col("n").alias("crowd"), _packed_bins().alias("bins"))
    tokens = nodes.select(F.explode(F.array(*_attribute_codes(F.col("bins")))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("seats"))
    return nodes, materialise(tokens)


def seated(nodes: DataFrame, tokens: DataFrame) -> DataFrame:
    """(token, seat, to): the nodes that have a token, numbered from 0; ``to`` is the place, crowd and bins of one. Nodes that
    agree in these may change seats. A token of many nodes is numbered in parts, each from where the parts before it end."""
    nodes = nodes.select("at", "crowd", "bins")
    own = nodes.select(F.col("at").alias("token"), F.col("crowd").alias("seats"), "*")
    shared = nodes.select(F.explode(F.array(*_attribute_codes(F.col("bins")))).alias("token"), "*").join(F.broadcast(tokens), "token")
    salt = F.when(F.col("seats") > SALT_ROWS, F.pmod(F.xxhash64("at", "bins"), F.ceil(F.col("seats") / SALT_ROWS))).otherwise(F.lit(0).cast("bigint"))
    rows = own.unionByName(shared).withColumn("salt", salt)
    parts = rows.where(F.col("seats") > SALT_ROWS).groupBy("token", "salt").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("token").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("token", "salt", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    seat = F.row_number().over(Window.partitionBy("token", "salt").orderBy("at", "bins")) - 1
    rows = rows.drop("seats").withColumn("seat", seat.cast("bigint")).join(F.broadcast(parts), ["token", "salt"], "left")
    return rows.select("token", (F.col("seat") + F.coalesce("before", F.lit(0))).alias("seat"), F.array("at", "crowd", "bins").alias("to"))


def _visit(step: int) -> list[Column]:
    """What a path holds of a node: both names of its location as one number, and its bins."""
    names = [F.pmod(F.xxhash64("at", F.lit(k)), F.lit(LOCATION_NAMES)) for k in range(2)]
    return [(names[0] * LOCATION_NAMES + names[1]).alias(f"names{step}"), F.col("bins").alias(f"bins{step}")]


def walks(nodes: DataFrame, tokens: DataFrame) -> DataFrame:
    """(walk, path): WALKS walks from every node; the path holds the names and the bins of the visited nodes.

    A step takes one of the node's tokens, every other time its location, and goes to any node that has it."""
    members = seated(nodes, tokens).select(F.xxhash64("token", "seat").alias("key"), "to")  # one column, else the last step shuffles members of its own
    to = [F.col("to")[k].alias(n) for k, n in enumerate(("at", "crowd", "bins"))]
    starts = nodes.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(WALKS))))
    state = starts.select(F.xxhash64("node", "k").alias("walk"), "at", "crowd", "bins", *_visit(0))
    path = state.columns[-2:]
    for step in range(STEPS):
        die = F.pmod(F.xxhash64("walk", F.lit(step)), F.lit(2 * len(ATTRIBUTES)))
        token = F.when(die < len(ATTRIBUTES), F.col("at"))
        for k, code in enumerate(_attribute_codes(F.col("bins"))):
            token = token.when(die == len(ATTRIBUTES) + k, code)
        chosen = state.select("walk", *path, "crowd", token.alias("token"), (die < len(ATTRIBUTES)).alias("stays")).join(F.broadcast(tokens), "token", "left")
        seats = F.when(F.col("stays"), F.col("crowd")).otherwise(F.col("seats"))
        seat = F.pmod(F.xxhash64("walk", F.lit(step + 100)), seats)
        state = chosen.select("walk", *path, F.xxhash64("token", seat).alias("key")).join(members, "key").select("walk", *path, *to).select("*", *_visit(step + 1))
        path += state.columns[-2:]
    return state.select("walk", F.array(*path).alias("path"))


def _numbered(codes: np.ndarray):
    """The walks of a block to one row with the numbers of their words: names of the first kind, of the second, attributes."""

    def run(key, table):
        path = table.column("path").combine_chunks().flatten().to_numpy().reshape(table.num_rows, 2 * (STEPS + 1))
        path = path[np.lexsort(path.T)].reshape(-1, STEPS + 1, 2)
        words = np.empty((*path.shape[:2], 2 + len(ATTRIBUTES)), np.int32)
        words[..., 0], words[..., 1] = path[..., 0] // LOCATION_NAMES, LOCATION_NAMES + path[..., 0] % LOCATION_NAMES
        n, mask = len(ATTRIBUTES), (1 << BIN_BITS) - 1
        for k in range(n):
            code = (((path[..., 1] >> (BIN_BITS * n)) + 2 * k) << BIN_BITS) | ((path[..., 1] >> (BIN_BITS * (n - 1 - k))) & mask)
            words[..., 2 + k] = 2 * LOCATION_NAMES + np.searchsorted(codes, code)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([words.tobytes()], pa.binary())})

    return run


def _sums(rows: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each of ``n`` places."""
    d = rows.shape[1]
    return np.bincount((places[:, None] * d + np.arange(d)).ravel(), rows.ravel(), n * d).reshape(n, d).astype(np.float32)


def descend(words: np.ndarray, inner: np.ndarray, outer: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Skip-gram with negative sampling over all walks of a block, changing both tables of vectors in place: a word predicts
    the other words of its record and those of the records beside it in the walk. Returns how often each word occurs."""
    n, nodes, width = words.shape
    size = nodes * width
    at = np.repeat(np.arange(nodes), width)
    window = ((np.abs(at[:, None] - at[None, :]) <= 1) & ~np.eye(size, dtype=bool)).astype(np.float32)
    words = words.reshape(n, size)
    seen = np.bincount(words.ravel(), minlength=len(inner))
    likely = np.cumsum(seen**0.75)
    weight = np.float32(NEGATIVE_WEIGHT / NEGATIVES) * np.tile(window.sum(axis=1), min(n, STEP_WALKS))[:, None]
    slot = np.empty(len(inner), np.int64)
    speeds = [np.full((len(inner), 1), 1e-6, np.float32) for _ in range(2)]

    def move(table: np.ndarray, speed: np.ndarray, which: np.ndarray, slope: np.ndarray) -> None:
        speed[which] += (slope * slope).mean(axis=1, keepdims=True)
        table[which] += RATE * slope / np.sqrt(speed[which])

    for _ in range(-(-LEAST_STEPS // -(-n // STEP_WALKS))):
        turn = rng.permutation(n)
        for first in range(0, n, STEP_WALKS):
            flat = words[turn[first : first + STEP_WALKS]].ravel()
            drawn = np.searchsorted(likely, rng.random(NEGATIVES) * likely[-1], side="right")
            both = np.concatenate([flat, drawn])
            which = np.flatnonzero(np.bincount(both, minlength=len(inner)))
            slot[which] = np.arange(len(which))
            centres, away = inner.take(flat, axis=0), outer.take(drawn, axis=0)
            a, b = centres.reshape(-1, size, DIMENSIONS), outer.take(flat, axis=0).reshape(-1, size, DIMENSIONS)
            with np.errstate(over="ignore"):
                miss = window / (1 + np.exp(a @ b.transpose(0, 2, 1)))
                hit = weight[: len(flat)] / (1 + np.exp(-(centres @ away.T)))
            of_inner = (miss @ b).reshape(-1, DIMENSIONS) - hit @ away
            of_outer = np.concatenate([(miss.transpose(0, 2, 1) @ a).reshape(-1, DIMENSIONS), -(hit.T @ centres)])
            move(inner, speeds[0], which, _sums(of_inner, slot[flat], len(which)))
            move(outer, speeds[1], which, _sums(of_outer, slot[both], len(which)))
    return seen


def _fitted(shared, last: bool):
    """Blocks of walks to sums over the task's blocks, in PARTS parts of the words: how often each occurs, and the vectors
    that each block ends with, as often as the word occurs in it. Outer vectors only serve a next round."""

    def run(batches):
        inner, outer = shared.value
        count, total = np.zeros(len(inner)), np.zeros((len(inner), (1 if last else 2) * DIMENSIONS))
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("words"), strict=True):
                words = np.frombuffer(raw.as_buffer(), np.int32).reshape(-1, STEPS + 1, 2 + len(ATTRIBUTES))
                own = inner.copy(), outer.copy()
                seen = descend(words, *own, np.random.default_rng(block))
                count += seen
                total += seen[:, None] * np.hstack(own[:1] if last else own)
        if count.any():
            for part in range(PARTS):
                yield pa.RecordBatch.from_pydict({"part": [part], "sums": [np.hstack([count[part::PARTS, None], total[part::PARTS]]).tobytes()]})

    return run


def _added(key, table):
    """The sum of the tasks' sums of one part."""
    total = sum(np.frombuffer(raw.as_buffer()) for raw in table.column("sums"))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "sums": pa.array([np.asarray(total).tobytes()], pa.binary())})


def train_vectors(rows: DataFrame, total: int) -> dict[str, np.ndarray]:
    """Skip-gram vectors by word, trained on walks from all ``total`` records; the vocabulary is bounded by LOCATION_NAMES and the bins.

    Every walk is in one block and every block in one round. The blocks of a round begin at the same vectors, those of the next
    at the mean of what they end with, where a block counts for a word as often as it has it. Blocks are cut by a hash, so the
    vectors do not depend on partitions or the order of rows."""
    if not total:
        return {}
    spark = rows.sparkSession
    free_shuffles(spark)
    nodes, tokens = graph(rows)
    codes = np.array(sorted(r.token for r in tokens.collect()), np.int64)
    free_shuffles(spark)
    blocks = ROUNDS * max(1, round(total * WALKS / (ROUNDS * BLOCK_WALKS)))
    block = F.pmod(F.xxhash64("walk", F.lit(7)), F.lit(blocks)).alias("block")
    packed = materialise(walks(nodes, tokens).select(block, "path").groupBy("block").applyInArrow(_numbered(codes), "block bigint, words binary"))
    discard(tokens)
    size = 2 * LOCATION_NAMES + len(codes)
    inner = np.random.default_rng(5).uniform(-0.5, 0.5, (size, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    outer = np.zeros((size, DIMENSIONS), np.float32)
    count = np.zeros(size)
    free_shuffles(spark)
    for turn in range(ROUNDS):
        last = turn == ROUNDS - 1
        shared = spark.sparkContext.broadcast((inner, outer))
        sums = packed.where(F.pmod("block", F.lit(ROUNDS)) == turn).mapInArrow(_fitted(shared, last), "part bigint, sums binary").groupBy("part").applyInArrow(_added, "part bigint, sums binary").collect()
        shared.destroy()
        inner, outer = inner.copy(), outer.copy()
        for r in sums:
            part = np.frombuffer(r.sums).reshape(-1, 1 + (1 if last else 2) * DIMENSIONS)
            count[r.part :: PARTS] += part[:, 0]
            met = np.flatnonzero(part[:, 0])
            mean = part[met, 1:] / part[met, :1]
            inner[r.part + PARTS * met] = mean[:, :DIMENSIONS]
            if not last:
                outer[r.part + PARTS * met] = mean[:, DIMENSIONS:]
    discard(packed)
    free_shuffles(spark)
    names = [f"{kind}{k}" for kind in "kl" for k in range(LOCATION_NAMES)] + [_spelled(int(c)) for c in codes]
    return {w: inner[k] for k, w in enumerate(names) if count[k]}


def vector_tables(vectors: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(vectors of attribute words, vectors of both kinds of location names). Each is centred within its kind and source, so
    that what tells the sources apart drops out, and of length 1; a location name that no walk met has a fixed random vector."""
    rng = np.random.default_rng(11)
    names = rng.standard_normal((2, LOCATION_NAMES, DIMENSIONS)).astype(np.float32)
    attributes = {}
    for kind in ("k", "l", *(f"{a}{src}_" for a in ATTRIBUTES for src in (0, 1))):
        words = [w for w in vectors if w.startswith(kind)]
        middle = np.mean([vectors[w] for w in words], axis=0) if words else 0.0
        for w in words:
            if kind in "kl":
                if len(words) > 1:
                    names["kl".index(kind), int(w[1:])] = _unit(vectors[w] - middle)
            else:
                attributes[w] = _unit(vectors[w] - middle)
    names /= np.linalg.norm(names, axis=2, keepdims=True)
    return attributes, names


def _unit(v: np.ndarray) -> np.ndarray:
    return v / max(float(np.linalg.norm(v)), 1e-9)


def attribute_part(attributes: dict[str, np.ndarray], src: np.ndarray, *bins: pa.Array) -> np.ndarray:
    """The sum of the records' weighted attribute vectors. A word that no walk met gets a random vector by its name."""
    total = np.zeros((len(src), DIMENSIONS), np.float32)
    for kind, values in zip(ATTRIBUTES, bins, strict=True):
        numbers = values.cast(pa.int64()).fill_null(NO_BIN).to_numpy(zero_copy_only=False)
        which, at = np.unique(2 * numbers + src, return_inverse=True)
        words = [f"{kind}{n & 1}_{'none' if n >> 1 == NO_BIN else n >> 1}" for n in which.tolist()]
        for w in set(words) - attributes.keys():
            attributes[w] = _unit(np.random.default_rng(abs(hash_of(w))).standard_normal(DIMENSIONS)).astype(np.float32)
        total += ATTRIBUTE_WEIGHT * np.array([attributes[w] for w in words], np.float32).reshape(-1, DIMENSIONS)[at]
    return total


def hash_of(word: str) -> int:
    return int.from_bytes(word.encode()[:8].ljust(8, b"\0"), "big")


def table_plan(n_first: int, n_second: int) -> tuple[int, int]:
    """(bits, tables): bits for buckets of a few dozen records, whatever their number, and the tables that MISS asks for."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(n_first + n_second, 1))) - SPARED_BITS))
    return bits, math.ceil(math.log(MISS) / math.log(1 - AGREE**bits))


def _bucketed(shared):
    """Records in cells to (id, place, wide, buckets): one bucket per table, and per salt in a crowded cell."""

    def run(batches):
        (attributes, names), planes = shared.value
        tables, bits, _ = planes.shape
        for batch in batches:
            src, ids, cell, crowd, at_k, at_l = (batch.column(c).to_numpy() for c in ("src", "id", "cell", "n", "k", "l"))
            v = names[0, at_k] + names[1, at_l]
            v *= LOCATION_WEIGHT / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
            v += attribute_part(attributes, src, *(batch.column(a) for a in ATTRIBUTES))
            signs = (np.einsum("nd,tbd->ntb", v, planes, optimize=True) > 0) @ (np.int64(1) << np.arange(bits, dtype=np.int64))
            salts = np.maximum(-(-crowd // SALT_ROWS), 1)
            copies = np.where(src == 1, salts, 1)
            row = np.repeat(np.arange(len(src)), copies)
            salt = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
            salt = np.where(src[row] == 1, salt, (ids[row] * np.int64(0x9E3779B1) >> 13) % salts[row])
            keys = signs[row] * np.int64(1_000_003) + np.arange(tables) * np.int64(0x632BE59BD9B4E019) + (salt * np.int64(7_046_029_254_386_353_131))[:, None]
            offsets = np.concatenate([[0], np.cumsum(copies)]) * tables
            buckets = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "place", "wide")), buckets], ["id", "place", "wide", "buckets"])

    return run


def bucket_pairs(rows: DataFrame, tables: tuple[dict[str, np.ndarray], np.ndarray], bits: int, n_tables: int) -> DataFrame:
    """(id, id2): records of the first and second source that share a bucket and are within reach by their packed places.

    Records of a bucket meet by strips of the sky, a second-source record in every strip its reach touches: a bucket may
    hold many records from everywhere, and no pair within reach is in different strips only."""
    planes = np.random.default_rng(23).standard_normal((n_tables, bits, DIMENSIONS)).astype(np.float32)
    shared = rows.sparkSession.sparkContext.broadcast((tables, planes))
    named = rows.withColumns({kind: F.pmod(F.xxhash64("cell", F.lit(k)), F.lit(LOCATION_NAMES)).cast("int") for k, kind in enumerate("kl")})
    schema = "id bigint, place bigint, wide boolean, buckets array<bigint>"
    slack = 4.0 / PACK
    reach = F.when(F.col("wide"), math.ceil((WIDE_RADIUS + slack) * PACK)).otherwise(math.ceil((RADIUS + slack) * PACK))
    strips = F.array(F.shiftright("place", 42 + STRIP_BITS)), F.sequence(*[F.shiftright(F.shiftright("place", 42) + s * reach, STRIP_BITS) for s in (-1, 1)])
    a, b = (named.where(F.col("src") == s).select("src", "id", "cell", "n", "k", "l", "place", "wide", *ATTRIBUTES).mapInArrow(_bucketed(shared), schema).withColumn("strip", F.explode(strips[s])).withColumn("bucket", F.explode("buckets")) for s in (0, 1))
    key = F.xxhash64("bucket", "strip").alias("key")
    a = a.select("id", "place", key)
    b = b.select(F.col("id").alias("id2"), F.col("place").alias("place2"), "wide", key)
    near = chord2(tuple(_unpacked("place")), tuple(_unpacked("place2"))) <= F.when(F.col("wide"), (WIDE_RADIUS + slack) ** 2).otherwise((RADIUS + slack) ** 2)
    return a.join(b, "key").where(near).select("id", "id2").distinct()


def _cosines(shared):
    """Pairs to their cosine: the location of both is the one of the cell they share."""

    def run(batches):
        attributes, _ = shared.value
        for batch in batches:
            n = batch.num_rows
            a, b = (attribute_part(attributes, np.full(n, s), *(batch.column(f"{t}{s}") for t in ATTRIBUTES)).astype(np.float64) for s in (0, 1))
            square = LOCATION_WEIGHT**2
            cosine = (square + (a * b).sum(axis=1)) / np.sqrt((square + (a * a).sum(axis=1)) * (square + (b * b).sum(axis=1)))
            kept = [c for c in batch.schema.names if c[:-1] not in ATTRIBUTES]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(cosine)], [*kept, "cosine"])

    return run


def _bin(name: str, value: Column) -> Column:
    def below(edges: list, least: int) -> Column:
        if not edges:
            return F.lit(least)
        half = len(edges) // 2
        return F.when(value < F.lit(float(edges[half])), below(edges[:half], least)).otherwise(below(edges[half + 1 :], least + half + 1))

    edges = sorted(BINS[name])
    return F.when(value.isNull(), F.lit(len(edges) + 1)).otherwise(below(edges, 0))


def fit_lines(pairs: DataFrame) -> dict[str, tuple[float, float]]:
    """(constant, slope) of the second source's magnitude less the first's ("mag"), and of its colour ("colour"), as lines in
    the first's colour, by the normal equations over close pairs; pairs beyond the gate are left out of a second fit."""
    x = F.col("colour")
    targets = {"mag": F.col("mag2") - F.col("mag"), "colour": F.col("colour2")}
    lines: dict[str, tuple[float, float]] = {}
    spread: dict[str, float] = {}
    for _ in range(3):
        sums = []
        for n, y in targets.items():
            ok = x.isNotNull() & y.isNotNull()
            if n in lines:
                ok = ok & (F.abs(y - lines[n][0] - lines[n][1] * x) <= GATE * spread[n])
            on = lambda v, ok=ok: F.sum(F.when(ok, v))
            sums += [F.count_if(ok), on(x), on(y), on(x * x), on(x * y), on(y * y)]
        row = pairs.where(F.col("sep") <= CLOSE_ARCSEC).agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
        for k, n in enumerate(targets):
            count, sx, sy, sxx, sxy, syy = (float(v or 0) for v in row[6 * k : 6 * k + 6])
            spread_x = count * sxx - sx * sx
            if count < LEAST_PAIRS or spread_x <= 1e-9 * max(count * sxx, 1e-9):
                lines.setdefault(n, (sy / count if count else 0.0, 0.0))
                spread.setdefault(n, 1.0)
                continue
            slope = (count * sxy - sx * sy) / spread_x
            constant = (sy - slope * sx) / count
            lines[n] = constant, slope
            rest = syy - 2 * (constant * sy + slope * sxy) + count * constant**2 + 2 * constant * slope * sx + slope**2 * sxx
            spread[n] = max(math.sqrt(max(rest, 0.0) / count), 1e-3)
    return lines


def measured(pairs: DataFrame, first: DataFrame, second: DataFrame, attributes: dict[str, np.ndarray]) -> DataFrame:
    """Pairs within reach with their exact separation, the measures of both sides and the cosine."""
    columns = ("x", "y", "z", "wide", "mag", "colour", "plx", "e_plx")
    a = first.select("id", *columns, *[b.alias(f"{n}0") for b, n in zip(_bins(), ATTRIBUTES, strict=True)])
    b = second.select(F.col("id").alias("id2"), *[F.col(c).alias(f"{c}2") for c in columns], *[b.alias(f"{n}1") for b, n in zip(_bins(), ATTRIBUTES, strict=True)])
    sep = arcsec_of_chord2(chord2(tuple(F.col(c) for c in "xyz"), tuple(F.col(f"{c}2") for c in "xyz")))
    limit = F.when(F.col("wide2"), REACH + YEARS * UNRECORDED_MOTION).otherwise(REACH)
    raw = pairs.join(a, "id").join(b, "id2").withColumn("sep", sep).where(F.col("sep") <= limit)
    tokens = [f"{n}{s}" for s in (0, 1) for n in ATTRIBUTES]
    raw = raw.select("id", "id2", "sep", "mag", "mag2", "colour", "colour2", "plx", "plx2", "e_plx", "e_plx2", *tokens)
    schema = "id bigint, id2 bigint, sep double, mag double, mag2 double, colour double, colour2 double, plx double, plx2 double, e_plx double, e_plx2 double, cosine double"
    shared = pairs.sparkSession.sparkContext.broadcast((attributes, None))
    return raw.mapInArrow(_cosines(shared), schema)


def compared(raw: DataFrame, lines: dict[str, tuple[float, float]]) -> DataFrame:
    """Measured pairs with their exact differences and the bin of each; ``lines`` from ``fit_lines``."""
    (shift, slope), (zero, ratio) = lines["mag"], lines["colour"]
    from_second = (F.col("colour2") - zero) / ratio if ratio else F.lit(None).cast("double")
    expected = F.col("mag") + shift + slope * F.coalesce("colour", from_second, F.lit(0.8))
    error = F.sqrt(F.pow(F.coalesce("e_plx2", F.lit(1.5)), 2) + F.pow(F.coalesce("e_plx", F.lit(0.05)), 2))
    exact = raw.select("id", "id2", "sep", F.abs(expected - F.col("mag2")).alias("mag"), F.abs(zero + ratio * F.col("colour") - F.col("colour2")).alias("colour"), F.abs((F.col("plx") - F.col("plx2")) / error).alias("plx"), "cosine")
    return exact.withColumns({f"{n}_bin": _bin(n, F.col(n)) for n in BINS})


def fit_evidence(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, dict[str, np.ndarray]]:
    """Expectation-maximisation over counted patterns: prior log odds and, per measure and bin, the
    log ratio of its frequency among matches and non-matches."""
    names = list(BINS)
    sep, mag = patterns[:, names.index("sep")], patterns[:, names.index("mag")]
    w = np.where((sep <= 2) & (mag <= 4), 0.9, 0.05)
    for _ in range(rounds):
        prior = np.log(((w * counts).sum() + 1) / (((1 - w) * counts).sum() + 1))
        odds, evidence = np.full(len(w), prior), {}
        for k, n in enumerate(names):
            size = len(BINS[n]) + 2
            m, u = (np.bincount(patterns[:, k], x * counts, size) + 0.5 for x in (w, 1 - w))
            ratio = EVIDENCE.get(n, 1.0) * np.log(m / m.sum() / (u / u.sum()))
            ratio[-1] = 0.0
            evidence[n] = ratio
            odds = odds + ratio[patterns[:, k]]
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        done = np.abs(new - w).max(initial=0.0) < 1e-5
        w = new
        if done:
            break
    return float(prior), evidence


def match_entities(survey: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(id, id2, sep, mag, colour, plx, cosine, confidence) of all pairs of one bucket within reach.

    ``survey`` and ``catalogue``: the raw deliveries ``first_source`` and ``second_source`` read."""
    with hash_joins(survey.sparkSession):
        second = materialise(second_source(catalogue))
        first = materialise(first_source(survey, cells_within_reach(second)))
        rows = materialise(shared_tokens(first, second))
        n_second, total = rows.agg(F.sum("src"), F.count(F.lit(1))).first()
        tables = vector_tables(train_vectors(rows, total))
        near = bucket_pairs(rows, tables, *table_plan(total - (n_second or 0), n_second or 0))
        raw = materialise(measured(near, first, second, tables[0]))
    for done in (first, second, rows):
        discard(done)
    pairs = compared(raw, fit_lines(raw))
    bins = [f"{n}_bin" for n in BINS]
    counted = pairs.groupBy(*bins).agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row per combination of bins
    table = np.array([tuple(r) for r in counted], np.int64).reshape(-1, len(bins) + 1)
    prior, evidence = fit_evidence(table[:, :-1], table[:, -1].astype(float))
    odds = F.lit(prior)
    for n in BINS:
        odds = odds + F.array(*[F.lit(float(x)) for x in evidence[n]])[F.col(f"{n}_bin")]
    return pairs.withColumn("confidence", 1 / (1 + F.exp(-odds))).drop(*bins)
