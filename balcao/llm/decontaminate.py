"""Find benchmark items in documents by SimHash of item-sized windows.

Words are lower-cased runs of letters and digits; a shingle is five successive
words (all words of a shorter item). For each item, windows of its own length are
fingerprinted with a 64-bit SimHash of their shingles and looked up in a
multi-index: eight blocks of eight bits, each stored with all values up to two
flipped bits, so every item within ``RADIUS`` = 23 bits is a candidate. As blocks of
eight bits alone select little, the index is keyed by the item too, and a window is
looked up under the items for which it was opened only. A candidate
is kept if its exact similarity, twice the shared shingle weight over the sum of
both weights (a shingle weighs its number of occurrences), is at least
``SIMILARITY``.

Only windows that can reach the similarity are fingerprinted: one that does shares
at least one of any n - ceil(SIMILARITY * n / (2 - SIMILARITY)) + 1 shingles of its item, so a document
and an item are compared if they share one of the item's rarest shingles. Of the
document's windows, in whatever order the item's parts stand there, all are taken
that hold enough shingles of the item. A document shorter than an item is one window.

Null and empty texts and items match nothing. Rows are told apart by id and text;
rows equal in both count once. Extra columns are not read. Everything runs in
DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from balcao.sources.scratch import stage

WORDS = 5
SIMILARITY = 0.8
RADIUS = 23
_BLOCKS, _BLOCK_BITS, _FLIPS = 8, 8, 2
#: Numbers of eight bytes that a side sent to every task may hold in all (16 MB); larger sides are shuffled.
BROADCAST_NUMBERS = 2_000_000

_KEY = ("key_1", "key_2")


def _of_size(k: Column) -> Column:
    """The shingles of ``hashes`` with ``k`` words, ``WORDS`` at most."""
    return reduce(lambda rest, n: F.when(k == n, _shingles("hashes", n)).otherwise(rest), range(1, WORDS), _shingles("hashes", WORDS))


def _word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words, in order; an empty array for fewer words."""
    n = F.size(hashes) - k

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(k)])

    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), run)).otherwise(
        F.array().cast("array<bigint>")
    )


def _sent(side: DataFrame) -> DataFrame:
    """A staged side of numbers and arrays of numbers, sent to every task if it holds few in all."""
    held = [_numbers(field.dataType, F.col(field.name)) for field in side.schema]
    total = side.select(F.sum(reduce(lambda a, b: a + b, held)).alias("held")).first().held or 0
    return F.broadcast(side) if total <= BROADCAST_NUMBERS else side


def _numbers(kind: DataType, value: Column) -> Column:
    """How many numbers a value holds; an array counts one more for its own size."""
    if isinstance(kind, ArrayType):
        width = len(kind.elementType.fields) if isinstance(kind.elementType, StructType) else 1
        return F.greatest(F.size(value), F.lit(0)) * width + 1
    return F.lit(1)


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, length, k, shingles) of each distinct item with words; ``item`` is never null."""
    hashed = benchmark.select("item_id", _word_hashes(F.col("text")).alias("hashes")).filter(F.size("hashes") > 0).distinct()
    k = F.least(F.size("hashes"), F.lit(WORDS))
    return hashed.withColumn("k", k).select(
        F.xxhash64("item_id", "hashes").alias("item"),
        "item_id",
        F.size("hashes").alias("length"),
        "k",
        _of_size(F.col("k")).alias("shingles"),
    )


def with_form(items: DataFrame) -> DataFrame:
    """Items of the same words in the same order are one form."""
    return items.withColumn("form", F.xxhash64("shingles"))


def _anchors(items: DataFrame, similarity: float) -> DataFrame:
    """(k, shingle, form, length): the rarest shingles of each item, enough to miss no match.

    A window of as many shingles as the item (n) needs similarity * n shared ones; one
    in a shorter document has m < n of them and needs similarity * (n + m) / 2 <= m,
    that is at least n * similarity / (2 - similarity).
    """
    placed = items.select("item", "length", "k", "form", F.posexplode("shingles").alias("place", "shingle"))
    spread = placed.groupBy("k", "shingle").agg(F.count_distinct("item").alias("spread"))
    ranked = placed.join(spread, ["k", "shingle"]).withColumns(
        {
            "nth": F.row_number().over(Window.partitionBy("item").orderBy("spread", "shingle", "place")),
            "n": F.col("length") - F.col("k") + 1,
        }
    )
    needed = F.ceil(F.lit(similarity / (2 - similarity)) * F.col("n") - F.lit(1e-9))
    return ranked.filter(F.col("nth") <= F.col("n") - needed + 1).select("k", "shingle", "form", "length").distinct()


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        F.xxhash64(F.lit(1), "doc_id", "text").alias("key_1"),
        F.xxhash64(F.lit(2), "doc_id", "text").alias("key_2"),
        "text",
    ).filter("text is not null")


def _windows(keyed: DataFrame, items: DataFrame, anchors: DataFrame, similarity: float) -> DataFrame:
    """(key, form, begin, width, length): where an item of that form, of ``length`` words, may lie.

    A window of s shingles needs similarity * (s + n) / 2 of them in the item's n. Every
    so many successive places of the item's shingles bound the windows that hold them all.
    """
    hashed = keyed.select(*_KEY, _word_hashes(F.col("text")).alias("hashes"))
    sizes = [row.k for row in anchors.select("k").distinct().collect()]  # at most WORDS numbers
    own = _sent(anchors)
    parts = []
    for k in sorted(sizes):
        runs = hashed.select(*_KEY, F.explode(_shingles("hashes", k)).alias("shingle"))
        parts.append(runs.join(own.filter(F.col("k") == k), "shingle"))
    found = stage(reduce(DataFrame.unionByName, parts).select(*_KEY, "form", "k", "length").distinct(), "pares")
    per_doc = found.groupBy(*_KEY).agg(F.collect_list(F.struct("form", "k", "length")).alias("pairs"))
    asked = keyed.join(_sent(stage(per_doc, "pares-doc")), [*_KEY]).dropDuplicates([*_KEY])
    asked = asked.select(*_KEY, _word_hashes(F.col("text")).alias("hashes"), "pairs")
    asked = asked.select(*_KEY, "hashes", F.explode("pairs").alias("pair")).select(*_KEY, "hashes", "pair.*")
    forms = stage(items.select("form", F.array_distinct("shingles").alias("own"), F.size("shingles").alias("n_item")).distinct(), "formas")
    inside = F.transform(_of_size(F.col("k")), lambda x, at: F.when(F.array_contains("own", x), at))
    n, width = F.size("hashes"), F.least(F.size("hashes"), "length")
    placed = asked.join(forms, "form").select(
        *_KEY,
        "form",
        "length",
        n.alias("n"),
        width.alias("width"),
        (width - F.col("k") + 1).alias("s"),
        F.greatest(F.ceil(similarity * (width - F.col("k") + 1 + F.col("n_item")) / 2 - F.lit(1e-9)), F.lit(1)).cast("int").alias("needed"),
        F.filter(inside, lambda at: at.isNotNull()).alias("places"),
    )
    enough = F.filter("places", lambda _, i: i + F.col("needed") <= F.size("places"))
    ends = F.transform(
        enough,
        lambda at, i: F.struct(
            F.greatest(F.get("places", i + F.col("needed") - 1) - F.col("s") + 1, F.lit(0)).alias("low"),
            F.least(at, F.col("n") - F.col("width")).alias("high"),
        ),
    )
    bounded = placed.select(*_KEY, "form", "width", "length", F.explode(ends).alias("of")).filter("of.low <= of.high")
    begin = F.explode(F.sequence("of.low", "of.high")).alias("begin")
    return bounded.select(*_KEY, "form", begin, "width", "length").distinct()


def _fingerprint(shingle: str) -> Column:
    """SimHash of a group's shingles."""
    bits = [
        F.when(F.sum(F.shiftright(F.col(shingle), b).bitwiseAND(1) * 2 - 1) > 0, F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0))
        for b in range(64)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _block(fingerprint: Column, number: int) -> Column:
    return F.shiftright(fingerprint, number * _BLOCK_BITS).bitwiseAND((1 << _BLOCK_BITS) - 1).cast("int")


def _near_values() -> list[int]:
    """All block patterns of at most ``_FLIPS`` set bits."""
    return [x for x in range(1 << _BLOCK_BITS) if x.bit_count() <= _FLIPS]


def matches(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The best window of each document and item that match.

    Columns: doc_id, item_id, first_word, n_words, similarity, distance (of the fingerprints).
    """
    best = _best_windows(documents, benchmark, similarity)
    return best.select("doc_id", "item_id", F.col("begin").alias("first_word"), F.col("width").alias("n_words"), "similarity", "distance")


def _best_windows(documents: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    """The best window (begin, width) of each text, told apart by its keys, and item that match."""
    keyed = _keyed(documents.select("doc_id", "text"))
    items = with_form(stage(items_of(benchmark.select("item_id", "text")), "itens"))
    anchors = stage(_anchors(items, similarity), "ancoras")
    if anchors.isEmpty():
        return keyed.limit(0).select(
            "doc_id",
            *_KEY,
            F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
            F.lit(0).alias("begin"),
            F.lit(0).alias("width"),
            F.lit(0.0).alias("similarity"),
            F.lit(0).alias("distance"),
        )
    spots = stage(_windows(keyed, items, anchors, similarity), "janelas")
    spot = F.struct("begin", "width", "length")
    per_doc = spots.groupBy(*_KEY).agg(F.collect_set(spot).alias("spots"))
    own = _sent(stage(per_doc, "janelas-doc"))
    with_words = (
        keyed.join(own, [*_KEY])
        .dropDuplicates([*_KEY])
        .select("doc_id", *_KEY, "spots", _word_hashes(F.col("text")).alias("hashes"))
    )
    opened = with_words.select("doc_id", *_KEY, "hashes", F.explode("spots").alias("spot")).select(
        "doc_id", *_KEY, F.slice("hashes", F.col("spot.begin") + 1, F.col("spot.width")).alias("hashes"), "spot.*"
    )
    k = F.least(F.col("length"), F.lit(WORDS))
    shingled = opened.select("doc_id", *_KEY, "begin", "width", "length", F.explode(_of_size(k)).alias("shingle"))
    window_id = ["doc_id", *_KEY, "begin", "width", "length"]
    weighed = stage(shingled.groupBy(*window_id, "shingle").agg(F.count(F.lit(1)).alias("weight")), "telhas")

    item_weighed = items.select("item", "item_id", "form", F.explode("shingles").alias("shingle"))
    item_print = item_weighed.groupBy("item", "item_id", "form").agg(
        _fingerprint("shingle").alias("item_print"), F.count(F.lit(1)).alias("item_weight")
    )
    flips = F.explode(F.array(*[F.lit(x) for x in _near_values()])).alias("flip")
    blocks = F.explode(F.array(*[F.struct(F.lit(b).alias("no"), _block(F.col("item_print"), b).alias("value")) for b in range(_BLOCKS)]))
    index = item_print.select("*", blocks.alias("block")).select("*", flips).select(
        "item",
        "item_id",
        "form",
        "item_print",
        "item_weight",
        F.col("block.no").alias("no"),
        F.col("block.value").bitwiseXOR(F.col("flip")).alias("value"),
    )
    prints = weighed.groupBy(*window_id).agg(
        _fingerprint_weighted().alias("print"), F.sum("weight").alias("window_weight")
    )
    own_blocks = F.explode(F.array(*[F.struct(F.lit(b).alias("no"), _block(F.col("print"), b).alias("value")) for b in range(_BLOCKS)]))
    opened_for = prints.join(spots, [*_KEY, "begin", "width", "length"])
    asked = opened_for.select("*", own_blocks.alias("block")).select(
        *window_id, "form", "print", "window_weight", F.col("block.no").alias("no"), F.col("block.value").alias("value")
    )
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = (
        asked.join(index, ["form", "no", "value"])
        .withColumn("distance", distance)
        .filter(F.col("distance") <= RADIUS)
        .select(*window_id, "item", "item_id", "distance", "window_weight", "item_weight")
        .distinct()
    )
    pair = [*window_id, "item", "item_id"]
    item_counts = item_weighed.groupBy("item", "shingle").agg(F.count(F.lit(1)).alias("item_count"))
    shared = (
        stage(near, "candidatos")
        .join(weighed.drop("doc_id"), [c for c in window_id if c != "doc_id"])
        .join(item_counts, ["item", "shingle"])
        .groupBy(*pair, "distance", "window_weight", "item_weight")
        .agg(F.sum(F.least("weight", "item_count")).alias("shared"))
    )
    score = 2 * F.col("shared") / (F.col("window_weight") + F.col("item_weight"))
    kept = shared.withColumn("similarity", score).filter(F.col("similarity") >= similarity - 1e-12)
    best = F.row_number().over(Window.partitionBy(*_KEY, "item_id").orderBy(F.desc("similarity"), "begin"))
    return (
        kept.withColumn("nth", best)
        .filter("nth = 1")
        .select("doc_id", *_KEY, "item_id", "begin", "width", "similarity", "distance")
    )


def _fingerprint_weighted() -> Column:
    bits = [
        F.when(
            F.sum((F.shiftright(F.col("shingle"), b).bitwiseAND(1) * 2 - 1) * F.col("weight")) > 0,
            F.shiftleft(F.lit(1).cast("bigint"), b),
        ).otherwise(F.lit(0))
        for b in range(64)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def decontaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item.

    Rows are told apart by id and text: a row without id goes if it holds an item, and a
    row that shares the id of such a row stays if it holds none itself.
    """
    found = _best_windows(documents, benchmark, similarity)
    hit = stage(found.select(*[F.col(c).alias(f"of_{c}") for c in _KEY]).distinct(), "vazados")
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keys = [F.xxhash64(F.lit(i), "doc_id", "text").alias(c) for i, c in enumerate(_KEY, 1)]
    same = [F.col(c) == F.col(f"of_{c}") for c in _KEY]
    return documents.select(row, *keys).join(_sent(hit), same, "left_anti").select("row.*")
