"""MinHash near-dedup with ProbMinHash: signatures of distinct shingles, banding, verification, connected classes.

A text is the set of its word shingles (five words; a shorter text has one shingle of all its words), however often each
occurs, so all weights are equal. Each shingle is a Poisson process: its arrivals, drawn from its hash, fall on registers
at random, and a register keeps the shingle that arrives first. Arrivals come in ascending order, so a shingle is done once the next
one is later than the text's last register. With equal weights two signatures agree in a register with the Jaccard similarity
of the sets, which is also what decides about a link.
``BANDS`` bands of ``ROWS`` registers make candidates (a pair at 0.8 is missed with probability below 0.0001), and a candidate is a
link if the Jaccard similarity of the distinct shingles is ``threshold`` or more.

Equal texts are one node from the start. In a bucket (texts that share a band) nobody is paired with everybody: the
first node in hash order is its leader, and the others are compared with it, unless links already put both in one class.
That finds most classes. Nodes that still share a band with another class go on in buckets by their rarest shingles, where a pair is
only of use if it is of two classes and enough shingles are left for a link from the shared one on, in both texts (prefix filter with positions).
While such pairs could be many, they are first made with a few leaders of each bucket, four times as many in each round, since every link
found joins classes; then all that are left are compared. So no candidate link between classes is lost, and no bucket has a cap.

Defined results: null texts are empty; a text without words is near nothing but its copies; ``class_id`` is the smallest id of a class,
null if all are null; of rows that repeat a class's smallest id one is kept; an empty table gives an empty result; other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.llm.common import materialise, packed, text_or_empty
from tokenloom.session import shared_path, ship_package

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
FIRST_BANDS = 6
SALTS = 64
# comparisons a member of a bucket may cost before more links are looked for with leaders
WORK = 1
SLICE_BYTES = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every bit of the input moves half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """A batch in slices of about ``limit`` bytes of text, so that a worker's arrays stay small; a long text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield texts.slice(a, b - a)


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: number of the text, hash, and occurrences; in order of text and hash."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    vocabulary = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], dtype="uint64")
    codes = coded.indices.to_numpy(zero_copy_only=False)
    visible = np.array([bool(w) for w in vocabulary], dtype=bool)[codes] if len(codes) else np.zeros(0, dtype=bool)
    owner, hashed = owner[visible], hashes[codes[visible]] if len(codes) else np.zeros(0, dtype="uint64")
    total = len(owner)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    # a shingle starts at each word that has enough words after it, and at the first word of a short text
    left = np.repeat(ends, counts) - np.arange(total)
    first = np.repeat(ends - counts, counts) == np.arange(total)
    starts = np.flatnonzero((left >= words) | first)
    value = np.zeros(len(starts), dtype="uint64")
    for j in range(words):
        inside = left[starts] > j
        value[inside] = mixed(value[inside] * _GOLD + hashed[starts[inside] + j])
    of = owner[starts]
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    new = np.r_[True, (of[1:] != of[:-1]) | (value[1:] != value[:-1])] if len(of) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    return of[at], value[at], np.diff(np.r_[at, len(of)])


def prob_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """Signature matrix: the element that arrives first in each register of each text."""
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, dtype="uint64")
    time = np.zeros(len(owner))
    step = 0
    with np.errstate(over="ignore"):
        while len(owner):
            step += 1
            draw = mixed(element + _GOLD * np.uint64(step))
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / weight
            register = (mixed(draw + _GOLD) % np.uint64(registers)).astype("int64")
            last = first.reshape(texts, registers).max(axis=1)
            early = time < last[owner]
            owner, element, weight, time, register = owner[early], element[early], weight[early], time[early], register[early]
            place = owner * registers + register
            np.minimum.at(first, place, time)
            won = time == first[place]
            winner[place[won]] = element[won]
    return winner.reshape(texts, registers)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(1, bands + 1, dtype="uint64") * _GOLD, (len(signatures), 1))
        for j in range(rows):
            key = mixed(key * _GOLD + signatures[:, j::rows][:, :bands])
    return key.view("int64")


def signatures(docs: DataFrame, id: str, text: str, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """``id, node`` (128-bit hash of the text) and ``bands``, an array of band keys, empty for a text without words."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("array<bigint>")
    def keyed(texts: pa.Array) -> pa.Array:
        parts = []
        for piece in text_slices(texts):
            owner, element, _ = shingles(piece, words)
            # a link is decided on sets, so candidates must not depend on how often a shingle occurs
            keys = band_keys(prob_minhash(owner, element, np.ones(len(owner)), len(piece), bands * rows), bands, rows)
            held = np.bincount(owner, minlength=len(piece)) > 0
            offsets = np.cumsum(np.r_[0, np.where(held, bands, 0)])
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[held].ravel())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    body = text_or_empty(text)
    return docs.select(F.col(f"`{id}`").alias("id"), node_of(body).alias("node"), keyed(body).alias("bands"))


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def _salts() -> Column:
    return F.expr("bit_or(shiftleft(1L, salt))").alias("salts")


def _per_salt() -> Column:
    """A row for each salt that occurs."""
    return F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), b -> getbit(salts, b) = 1)"))


def _members(nodes: DataFrame) -> DataFrame:
    """Members ``key, salt, node, band, salts`` of buckets with two nodes or more. Sizes go to the members by (key, salt)."""
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key")).withColumn("salt", _salt("node"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), _salts())
    return buckets.join(sizes.filter("n > 1").withColumn("salt", _per_salt()).drop("n"), ["key", "salt"])


def _pair(one: Column, other: Column) -> list[Column]:
    """Columns ``a, b`` of a pair of nodes and ``class_a, class_b``, the larger node first; the sides are structs of node and class."""
    a, b = F.greatest(one, other), F.least(one, other)
    return [a["node"].alias("a"), b["node"].alias("b"), a["class"].alias("class_a"), b["class"].alias("class_b")]


def _led(members: DataFrame, leaders: int) -> DataFrame:
    """Pairs of use: every member with the first ``leaders`` nodes of its bucket, those that reach furthest and then in hash order.

    A text with few shingles of its own reaches far and has the most links. The window keeps so many rows per bucket, and each task does so before anything moves.
    """
    first = members.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("reach"), "node"))).filter(F.col("place") <= leaders)
    heads = first.groupBy("key").agg(F.collect_list(F.struct("node", "class", "need", "reach")).alias("heads"), F.max("salts").alias("salts"))
    spread = heads.withColumn("salt", _per_salt()).drop("salts")
    before = F.struct(-F.col("reach"), F.col("node"))
    fit = F.filter("heads", lambda h: (F.struct(-h["reach"], h["node"]) < before) & _of_use(F.col, lambda c: h[c]))
    pairs = members.join(spread, ["key", "salt"]).select(F.struct("node", "class").alias("x"), F.explode(fit).alias("h"))
    pairs = pairs.select("x", F.struct(F.col("h.node").alias("node"), F.col("h.class").alias("class")).alias("y"))
    return pairs.select(*_pair(F.col("x"), F.col("y"))).distinct()


def _of_use(one: Callable[[str], Column], other: Callable[[str], Column]) -> Column:
    """Members of two classes, each of which has as many shingles left as a link with a text of the other's size takes."""
    return (one("class") != other("class")) & (one("reach") >= other("need")) & (other("reach") >= one("need"))


def _across(members: DataFrame) -> DataFrame:
    """All pairs of use in the buckets. One of each is outside its bucket's largest class, so that class meets the others alone."""
    sides = ["node", "class", "need", "reach"]
    one = members.filter("not main").select("key", "salt", F.struct(*sides).alias("x"))
    other = members.select("key", F.struct(*sides).alias("y"), "main")
    # a bucket's rows meet those of each salt in a task of its own
    spread = one.select("key", "salt").distinct().join(other, "key")
    once = F.col("main") | (F.col("x.node") > F.col("y.node"))
    pairs = one.join(spread, ["key", "salt"]).filter(once & _of_use(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")))
    bare = [F.struct(F.col(f"{side}.node").alias("node"), F.col(f"{side}.class").alias("class")) for side in "xy"]
    return pairs.select(*_pair(*bare)).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs, which are distinct, with their ``distance`` (Jaccard). Spark splits the rows of a node that is in many pairs."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.select(*pairs.columns, (1 - shared / (F.size("of_a") + F.size("of_b") - shared)).alias("distance"))


def _moved(rows: DataFrame, column: str, classes: DataFrame) -> DataFrame:
    """The column's nodes replaced by their class, where they have one. Spark splits the rows of a node that is in many."""
    found = classes.select(F.col("node").alias("of"), F.col("class").alias("to"))
    moved = rows.join(found, F.col(column) == F.col("of"), "left").withColumn(column, F.coalesce("to", column))
    return moved.select(*rows.columns)


def contracted(links: DataFrame) -> DataFrame:
    """``node, class``: for each node of the links one of the nodes it is connected with, the same for all of them.

    In each round every node goes to the first one of itself and its neighbours, in the order of a hash, and links become links between the
    nodes that are left, until there are none. In that order a chain loses about half of its nodes in a round, whatever their names.
    """

    def between(edges: DataFrame) -> DataFrame:
        ends = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return materialise(ends.distinct(), "edges")

    edges, steps = between(links), []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        first = F.min(F.least(*[F.struct(F.xxhash64(c).alias("place"), F.col(c).alias("node")) for c in "ab"]))
        steps.append(materialise(both.groupBy("a").agg(first.alias("first")).select(F.col("a").alias("node"), F.col("first.node").alias("class")), "steps"))
        edges = between(_moved(_moved(edges, "a", steps[-1]), "b", steps[-1]))
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("class"))
    classes = steps[0]
    for step in steps[1:]:
        classes = _moved(classes, "class", step)
    return materialise(classes, "classes") if len(steps) > 1 else classes


def components(links: DataFrame) -> DataFrame:
    """``node, class``: the smallest node that each node of the links is connected with."""
    classes = contracted(links).withColumn("salt", _salt("node"))
    whole = classes.groupBy("class").agg(F.min("node").alias("least"), _salts()).withColumn("salt", _per_salt())
    return classes.join(whole, ["class", "salt"]).select("node", F.col("least").alias("class"))


def near_classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
    words: int = WORDS,
) -> DataFrame:
    """``id, node, class_id, class_size, kept``: one row per input row."""
    signed = materialise(signatures(docs, id, text, bands, rows, words), "signatures").withColumn("salt", _salt("id"))
    equal = signed.groupBy("node").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), _salts())
    equal = materialise(equal, "texts")
    members = materialise(_members(equal), "buckets")
    nodes = equal.select("node", "low", "n", "salts", F.col("node").alias("class"))
    for classes in _joined(docs, id, text, members, equal.select("node", "low"), threshold, words):
        nodes = _moved(nodes, "class", classes)
    nodes = materialise(nodes.withColumn("asked", F.col("salts")).withColumn("salt", _salt("node")), "nodes")
    whole = nodes.groupBy("class").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"), _salts())
    answer = nodes.select("node", "class", "salt", "asked").join(whole.withColumn("salt", _per_salt()).drop("salts"), ["class", "salt"])
    answer = answer.select("node", "class_id", "class_size", F.col("asked").alias("salts")).withColumn("salt", _per_salt()).drop("salts")
    found = signed.select("id", "node", "salt").join(answer, ["node", "salt"])
    first = F.row_number().over(Window.partitionBy("class_id", "id").orderBy("node")) == 1
    kept = F.col("id").eqNullSafe(F.col("class_id"))
    return found.select("id", "node", "class_id", "class_size", (kept & first).alias("kept"))


def _joined(
    docs: DataFrame, id: str, text: str, members: DataFrame, lowest: DataFrame, threshold: float, words: int
) -> list[DataFrame]:
    """Steps ``node, class`` that lead each node to its class one after the other, by verified links between nodes that share a band."""

    @F.arrow_udf("array<bigint>")
    def sets_of(texts: pa.Array) -> pa.Array:
        parts = []
        for piece in text_slices(texts):
            owner, element, _ = shingles(piece, words)
            offsets = np.cumsum(np.r_[0, np.bincount(owner, minlength=len(piece))])
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(element.view("int64"))))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    body = text_or_empty(text)
    # of each text the row with the smallest id, so that copies do not meet
    asked = lowest.join(members.select("node"), "node", "left_semi").select(F.col("node").alias("at"), "low")
    rows = docs.select(F.col(f"`{id}`").alias("id"), node_of(body).alias("node"), body.alias("text"))
    rows = rows.join(asked, (F.col("node") == F.col("at")) & F.col("id").eqNullSafe(F.col("low")))
    once = F.row_number().over(Window.partitionBy("node", "id").orderBy(F.lit(0))) == 1
    rows = rows.withColumn("once", once).filter("once").select("node", "text")
    sets = materialise(rows.select("node", sets_of(F.col("text")).alias("shingles")), "shingle-sets")
    allowed = 1 - threshold + 1e-12
    # one table of all comparisons, with a folder for each round, so that plans stay as small as in the first one
    path, rounds, steps = shared_path(docs.sparkSession, "compared"), [], []
    schema = "a binary, b binary, class_a binary, class_b binary, distance double"

    def compare(pairs: DataFrame) -> bool:
        """Look for links, and join the classes that they are between; whether there were any."""
        if rounds:
            done = docs.sparkSession.read.schema(schema).parquet(*rounds).select("a", "b")
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        rounds.append(f"{path}/{len(rounds)}")
        verified(pairs, sets).write.parquet(rounds[-1])
        found = docs.sparkSession.read.schema(schema).parquet(rounds[-1]).filter(F.col("distance") <= allowed)
        steps.append(contracted(found.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))))
        return not steps[-1].isEmpty()

    # the first pass looks at a few bands, the second then passes over what is in one class already
    banded = members.withColumns({"class": F.col("node"), "need": F.lit(0.0), "reach": F.lit(0.0)})
    compare(_led(banded.filter(F.col("band") < FIRST_BANDS), 1))
    banded = _mixed_buckets(_moved(banded.drop("band"), "class", steps[-1]))
    compare(_led(banded, 1))
    banded = _mixed_buckets(_moved(banded, "class", steps[-1]))
    left = _rare_buckets(sets, banded.select("node").distinct(), threshold).withColumn("class", F.col("node"))
    for step in steps:
        left = _moved(left, "class", step)
    leaders, more = 4, True
    while True:
        left = _mixed_buckets(left)
        sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("main")).alias("others"))
        cost = sizes.agg(F.sum("n").alias("members"), F.sum(F.col("n") * F.col("others")).alias("pairs")).first()
        if not cost.pairs:
            break
        if cost.pairs <= WORK * cost.members or not more:
            compare(_across(left))
            break
        # without a new link further leaders would only find again what the pairs left over show
        more = compare(_led(left, leaders))
        left, leaders = _moved(left, "class", steps[-1]), leaders * 4
    return steps


def _rare_buckets(sets: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Members ``key, salt, node, need, reach`` of buckets by rare shingles, for nodes that share a band with another class.

    With shingles in one order for all texts, here from the rarest on, two texts of n shingles and a similarity of ``threshold`` agree in one of
    their first ``n - ceil(threshold * n) + 1``. So a passage that very many of them hold makes no bucket unless it is most of a text. From the
    first shared one on both must hold all that they share, which is ``threshold / (1 + threshold)`` of the sum of their sizes or more: the
    ``reach`` of one is the ``need`` of the other or more.
    """
    each = nodes.join(sets, "node").select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    each = materialise(each.withColumn("salt", _salt("node")), "shingles")
    counts = each.groupBy("key").agg(F.count(F.lit(1)).alias("held"), _salts())
    counted = each.join(counts.withColumn("salt", _per_salt()).drop("salts"), ["key", "salt"])
    place = F.row_number().over(Window.partitionBy("node").orderBy("held", "key"))
    first = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    rare = counted.withColumn("place", place).filter((F.col("place") <= first) & (F.col("held") > 1))
    need = F.lit(threshold) * F.col("n")
    reach = F.lit(1 + threshold) * (F.col("n") - F.col("place") + 1) - need + 1e-6
    return rare.select("key", "salt", "node", need.alias("need"), reach.alias("reach"))


def _mixed_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, whether theirs is the ``main`` one, the largest of the bucket, and the bucket's ``salts``.

    Members of the others stay if they are of use with any member.
    """
    # written first, since a class with many members would else be counted in one task after the join that gave it
    own = materialise(members.select("key", "salt", "node", "class", "need", "reach"), "classed")
    kinds = own.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("least"), F.max("reach").alias("most"), _salts())
    whole = kinds.groupBy("key").agg(
        F.max(F.struct("n", "class")).alias("largest"), F.count(F.lit(1)).alias("kinds"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.expr("bit_or(salts)").alias("salts"),
    )
    spread = whole.filter("kinds > 1").select("key", "least", "most", F.col("largest.class").alias("largest"), "salts", _per_salt().alias("salt"))
    found = own.join(spread, ["key", "salt"]).withColumn("main", F.col("class") == F.col("largest"))
    found = found.filter("main or (reach >= least and need <= most)")
    return materialise(found.select("key", "salt", "node", "class", "need", "reach", "main", "salts"), "open")


def near_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that stay, with all their columns: of each class one with the smallest id."""
    classes = near_classes(docs, id, text, **options).filter("kept").select(F.col("node").alias("at"), F.col("id").alias("wanted"))
    whole = packed(docs, id=F.col(f"`{id}`"), node=node_of(text_or_empty(text)))
    found = whole.join(classes, (F.col("node") == F.col("at")) & F.col("id").eqNullSafe(F.col("wanted")))
    tie = F.row_number().over(Window.partitionBy("node", "id").orderBy(F.xxhash64(F.to_json("row"))))
    return found.withColumn("first", tie == 1).filter("first").select("row.*")
