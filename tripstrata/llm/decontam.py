"""Benchmark items in documents, also where numbers, names or units were exchanged.

Words become templates: a number, a unit after a number and a name inside a sentence stand as
typed placeholders, like ones in a row as one, other words in lower case without outer
punctuation. Windows of the templates of both sides are joined by hash. Matches of one document
and item count together where their distances lie within a drift of a tenth of the item's
length and four words more, so inserted, missing or exchanged words do not part a copy; each
window of the item counts once. Within such a band a document's matches span little more than
the item's length, so their order is not tested beyond that. An item of at least ten windows may
lose the windows of one word, or a fifth of all if that is more. An alignment is checked for its
slots: where a value of the item has become several values, the alignment is of kind ``mixed``,
and is dropped only as weak evidence: an item of fewer than ``PLAIN_ENOUGH`` plain words, or of
fewer than it has such slots. All of it is DataFrame operations.

Template windows with fewer than ``LITERALS`` plain words are no evidence, so texts of numbers or
names alone do not match by them. Items are therefore joined a second time by windows of their
words as they are, in lower case, without that rule. Copies found by that only are of kind
``words``. An item shorter than a window is one window of its own length and of kind ``short``:
a word or three occur by themselves, so this says that the text holds them and is no ground to
drop a document. ``words``, ``mixed`` and ``short`` are asked for by ``kinds``; null texts have no words. Rows equal in id and text are one document. Tables without rows give
none. The windows of the items are broadcast only up to ``BROADCAST_WINDOWS``, which are
counted; beyond, both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep
from tripstrata.llm.rules import let

WINDOW = 5
SHARE = 0.8
LITERALS = 2
#: Kinds of evidence, the strongest first; ``find_leaks`` takes the first two if not told.
KINDS = ("exact", "changed", "words", "mixed", "short")
#: Plain words of an item that count although its slots do not hold together.
PLAIN_ENOUGH = 6
#: Item windows, of under 100 bytes each, that every executor may hold.
BROADCAST_WINDOWS = 1_000_000
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs day days week weeks "
    "month months year years hour hours minute minutes second seconds meter meters metre metres "
    "mile miles foot feet inch inches gram grams kilogram kilograms pound pounds ounce ounces liter "
    "liters litre litres gallon gallons percent dollar dollars euro euros cent cents usd eur degree "
    "degrees mph kmh km/h w kw kwh v a hz khz mhz ghz b kb mb gb tb"
).split()
PLACEHOLDERS = "(<(?:number|unit|name)>)"
#: Words by which distances may differ: so many, and one for each so many of the item.
DRIFT, DRIFT_EACH = 4, 10
# Patterns begin with what few places of a text have, as Java tries them at every place: white
# space that is not one space; punctuation, and only then whether it begins or ends a word.
_SPACE = r" [ \t\n\x0B\f\r]+|[\t\n\x0B\f\r][ \t\n\x0B\f\r]*"
_MARK = r"[.,;:!?\"'()\[\]]"
_OUTER = rf"{_MARK}(?:(?<=^.| .){_MARK}*|{_MARK}*(?= |$))"


def _run(kind: str) -> tuple[str, str]:
    """Pattern and replacement that join a row of placeholders of a kind, values parted by ``=``."""
    return rf"(?:(<{kind}>=)|\G(?<!^) <{kind}>(=))([^ ]+)", "$1$2$3"


def valued(text: Column) -> Column:
    """Templates of all words, one space between, placeholders with their values behind ``=``."""
    steps = [
        (_SPACE, " "),
        (r"(?=\p{Lu})(?<=[^ .!?:] )\p{Lu}[^ ]*", "<name>=$0"),
        (_OUTER, ""),
        (r"(?=[-+$€£0-9])(?:^|(?<= ))[-+$€£]?[0-9][0-9.,:/]*%?(?= |$)", "<number>=$0"),
        _run("name"),
        _run("number"),
        (rf"(<number>=[^ ]+ )({'|'.join(UNITS)})(?= |$)", "$1<unit>=$2"),
    ]
    out = F.coalesce(text, F.lit(""))
    for pattern, new in steps:
        out = F.regexp_replace(out, pattern, new)
    return F.lower(out)


def forms_of(text: Column) -> Column:
    """Templates of a text's words."""
    bare = F.regexp_replace(valued(text), f"{PLACEHOLDERS}=[^ ]*", "$1")
    return F.filter(F.split(bare, " +"), lambda f: f != "")


def slots_of(text: Column) -> Column:
    """For every template of a text its value, or null for a plain word."""
    words = F.filter(F.split(valued(text), " +"), lambda f: f != "")
    held = F.transform(words, lambda w: F.regexp_extract(w, f"^{PLACEHOLDERS}=(.*)$", 2))
    return F.transform(held, lambda v: F.when(v != "", v))


def words_of(text: Column) -> Column:
    """A text's words in lower case, without outer punctuation."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " ")
    out = F.regexp_replace(out, _OUTER, "")
    return F.filter(F.split(F.lower(out), " +"), lambda w: w != "")


def window_hashes(words: Column, window: int, *tag: Column) -> Column:
    """Hashes of the windows from every place."""
    return let(
        words,
        lambda f: F.when(
            F.size(f) >= window,
            F.transform(
                F.sequence(F.lit(0), F.size(f) - window),
                # As the hash of their slice, which is an array less for every window.
                lambda i: F.xxhash64(*(F.get(f, i + k) for k in range(window)), *tag),
            ),
        ),
    )


def _word_hashes(words: Column, window: int) -> Column:
    # Set apart from templates: without placeholders the two are alike.
    return window_hashes(words, window, F.lit("words"))


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """Windows of the items' templates that have enough plain words, and of all their words.

    Places count from 0. Windows of words have ``plain``, and their ``length``.
    """
    found = items.select(
        "item_row",
        forms_of(F.col("text")).alias("forms"),
        F.posexplode(window_hashes(forms_of(F.col("text")), window)).alias("item_at", "hash"),
    )
    plain = F.filter(
        F.slice("forms", F.col("item_at") + 1, window), lambda f: ~f.rlike(f"^{PLACEHOLDERS}$")
    )
    kinds = [F.lit(False).alias("plain"), F.lit(window).alias("length")]
    found = found.where(F.size(plain) >= LITERALS).select(
        "item_row", "item_at", "hash", _drift("forms"), *kinds
    )
    words = items.select("item_row", words_of(F.col("text")).alias("forms")).where("size(forms) > 0")
    whole = F.when(F.size("forms") < window, F.array(F.xxhash64("forms", F.lit("words"))))
    words = words.select(
        "item_row",
        F.posexplode(F.coalesce(whole, _word_hashes(F.col("forms"), window))).alias("item_at", "hash"),
        _drift("forms"),
        F.lit(True).alias("plain"),
        F.least(F.size("forms"), F.lit(window)).alias("length"),
    )
    return found.unionByName(words)


def _drift(forms: str) -> Column:
    return (DRIFT + F.floor(F.size(forms) / DRIFT_EACH)).cast("long").alias("drift")


def row_key(id_col: str, text_col: str) -> Column:
    """Hash that tells rows apart by id and text, also where either is null."""
    parts = (F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull())
    return F.xxhash64(*parts)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    kinds: tuple[str, ...] = KINDS[:2],
) -> DataFrame:
    """Documents that hold a benchmark item, as one row for each of the two.

    ``benchmark`` has ``item_id`` and ``text``. Returns :func:`row_key`, ``doc_id``, ``item_id``,
    ``n_matched`` and ``n_windows`` (of the item), and ``kind``: ``exact`` where all slots hold
    the item's values, ``changed`` where they hold others, ``words`` where only the words in
    lower case match, ``mixed`` where a value became several, ``short`` for an item of fewer
    words than a window. Only ``kinds`` are returned, the first of :data:`KINDS` that holds.
    """
    items = benchmark.select(
        F.monotonically_increasing_id().alias("item_row"), "item_id", F.col("text").alias("text")
    )
    items = keep(items, "items")
    told = keep(_item_windows(items, window), "item-windows")
    n = F.count(F.lit(1)).cast("long")
    sizes = told.groupBy("item_row", "plain").agg(
        n.alias("n_windows"), F.max("drift").alias("drift"), F.max("length").alias("longest")
    )
    sizes = sizes.withColumn("needed", _needed(F.col("n_windows"), window, share))
    if "words" not in kinds:
        told = told.where("not plain")
    lengths = [r.length for r in told.where("plain").select("length").distinct().collect()]
    told = told.drop("drift", "length")
    if told.count() <= BROADCAST_WINDOWS:
        told = F.broadcast(told)
    rows = docs.select(
        row_key(id_col, text_col).alias("row_key"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    # Places of windows of words follow those of templates; only their distances count.
    none = F.array().cast("array<bigint>")
    hashes = [window_hashes(forms_of(F.col("text")), window)]
    if lengths:
        hashes.append(
            let(words_of(F.col("text")), lambda w: F.concat(
                *(F.coalesce(_word_hashes(w, n), none) for n in sorted(lengths, reverse=True))
            ))
        )
    hashes = F.concat(*(F.coalesce(h, none) for h in hashes))
    windows = rows.select("row_key", "doc_id", F.posexplode(hashes).alias("at", "hash"))
    found = windows.join(told, "hash").withColumn("shift", F.col("at") - F.col("item_at"))
    place = ["row_key", "doc_id", "item_row", "plain"]
    lines = found.groupBy(*place, "shift").agg(F.collect_set("item_at").alias("ats"))
    lines = lines.join(sizes, ["item_row", "plain"])
    # Bands of twice the drift, each half over the next: any two distances within it share one.
    band = F.floor(F.col("shift") / F.col("drift"))
    bands = lines.withColumn("band", F.explode(F.array(band, band - 1)))
    matched = F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).cast("long")
    bands = bands.groupBy(*place, "n_windows", "needed", "longest", "band").agg(
        matched.alias("n_matched"), F.collect_list(F.struct("shift", "ats")).alias("lines")
    )
    lines = keep(bands.where("n_matched >= needed"), "alignments")
    keys = ["row_key", "item_row", "plain", "band"]
    judged = lines.join(_steadiness(lines.where("not plain"), items, rows, keys, window), keys, "left")
    enough = F.col("n_plain") >= F.greatest(F.lit(PLAIN_ENOUGH), "n_unsteady")
    kind = (
        F.when(F.col("plain") & (F.col("longest") < window), 4)
        .when(F.col("plain"), 2)
        .when(~F.coalesce("steady", F.lit(True)), F.when(enough, 3))
        .otherwise(F.when(F.coalesce("same", F.lit(True)), 0).otherwise(1))
    )
    judged = judged.withColumn("kind", kind).where(
        F.col("kind").isin([KINDS.index(k) for k in kinds])
    )
    first = F.min_by(F.struct("n_matched", "n_windows", "kind"), F.struct("kind", -F.col("n_matched")))
    best = judged.groupBy("row_key", "doc_id", "item_row").agg(first.alias("best"))
    return best.join(items.select("item_row", "item_id"), "item_row").select(
        "row_key",
        "doc_id",
        "item_id",
        "best.n_matched",
        "best.n_windows",
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("best.kind") + 1).alias("kind"),
    )


def _needed(n: Column, window: int, share: float) -> Column:
    """Windows of an item's ``n`` that must match: one word touches up to ``window`` of them."""
    one_edit = F.greatest(F.least(n * share, n - window), n / 2)
    return F.ceil(F.when(n > window, one_edit).otherwise(n * share))


def _steadiness(
    lines: DataFrame, items: DataFrame, rows: DataFrame, keys: list[str], window: int
) -> DataFrame:
    """For alignments of items with slots: does each value become one value, and the same?"""
    values = items.select("item_row", F.posexplode(slots_of(F.col("text"))).alias("item_at", "old"))
    values = values.where("old is not null")
    each = lines.select(*keys, F.explode("lines").alias("line")).select(*keys, "line.*")
    hits = each.select(*keys, "shift", F.explode("ats").alias("first"))
    covered = hits.select(
        *keys,
        "shift",
        F.explode(F.sequence(F.col("first"), F.col("first") + (window - 1))).alias("item_at"),
    )
    votes = covered.groupBy(*keys, "shift", "item_at").agg(F.count(F.lit(1)).alias("votes"))
    wanted = votes.join(values, ["item_row", "item_at"])
    # Slots outside of all matched windows stand at the distance of most windows.
    main = each.groupBy(*keys).agg(F.max_by("shift", F.size("ats")).alias("shift"))
    wanted = wanted.unionByName(main.join(values, "item_row").withColumn("votes", F.lit(0).cast("long")))
    wanted = wanted.groupBy(*keys, "item_at", "old").agg(F.max_by("shift", "votes").alias("shift"))
    wanted = wanted.select(*keys, "old", (F.col("item_at") + F.col("shift")).alias("at"))
    wanted = keep(wanted, "slots")
    texts = rows.join(wanted.select("row_key").distinct(), "row_key", "left_semi")
    new = texts.select("row_key", F.posexplode(slots_of(F.col("text"))).alias("at", "new"))
    pairs = wanted.join(new.where("new is not null").distinct(), ["row_key", "at"], "left")
    each = pairs.groupBy(*keys, "old").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("new").alias("lo"), F.max("new").alias("hi"), F.bool_or(F.col("new").isNull()).alias("gone")
    )
    same = (F.col("lo") == F.col("old")) & (F.col("hi") == F.col("old")) & ~F.col("gone")
    steady = F.coalesce(F.col("lo") == F.col("hi"), F.lit(True))
    plain = F.filter(slots_of(F.col("text")), lambda v: v.isNull())
    plain = items.select("item_row", F.size(plain).alias("n_plain"))
    return each.groupBy(*keys).agg(
        F.every(steady).alias("steady"),
        F.sum(F.when(steady, 0).otherwise(F.col("n"))).alias("n_unsteady"),
        F.every(F.coalesce(same, F.lit(False))).alias("same"),
    ).join(plain, "item_row")
