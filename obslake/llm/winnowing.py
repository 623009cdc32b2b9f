"""Document fingerprints by winnowing over k-grams of characters.

ASCII white space counts as one space, and none at the ends. Every run of GRAM characters
is hashed; of every WINDOW hashes in a row the least is marked, the rightmost of equal
ones, with its position. Two texts that share GRAM + WINDOW - 1 characters in a row
therefore share a mark, with or without spaces in them. A text of less than FEW grams has
all of them as marks: two such texts need to share GRAM characters only. A text shorter than
a gram is one gram. All of it is column expressions on arrays; a mark is one long, 32 bits of
hash above 31 bits that fall as the position rises, so that the least of a window is its
rightmost least hash.

A null text is empty; a text without words has no marks. Equal texts have equal marks. Two
empty fingerprints are alike (1), an empty one is unlike any other (0). Rows with a null
doc_id count as the lowest id; rows of the same id follow one another in the order of
their texts. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a gram, grams of a window, and of a text that keeps all.
GRAM, WINDOW, FEW = 8, 12, 48
#: Characters before an edit whose windows may reach into it.
_SEAM = GRAM + WINDOW - 2
#: The last characters of a text's beginning that decide which marks its windows have there.
_TAIL = GRAM + 2 * WINDOW - 3
#: Documents of a range of ids that is handled together, on average.
RANGE_ROWS = 2000
_QUANTILES = 64
_LOW = (1 << 31) - 1
_HIGH = 0xFFFFFFFF << 31
#: Characters that count as white space.
_SPACE = " \t\n\v\f\r"


def _spaced(text: Column) -> Column:
    return F.regexp_replace(text, "[ \\t-\\r]+", " ")


def _trimmed(text: Column) -> Column:
    return F.btrim(_spaced(text), F.lit(" "))


def _folded(rows: DataFrame, name: str, step: int, fold: Callable) -> DataFrame:
    """Folds every element of an array with the one ``step`` places on; the last keep theirs."""
    array = F.col(name)
    later = F.slice(array, F.lit(step + 1), F.size(array))
    return rows.withColumn(name, F.zip_with(array, later, fold))


def _with_hashes(rows: DataFrame, text: str, at: Column) -> DataFrame:
    """Adds ``_grams`` and ``_least``: marks of all grams, and the least of each window.

    ``text`` is spaced already and begins at position ``at``. The least of a window is
    found by doubling the width; there is none where less than a window is left.
    """
    # Each place where a gram begins matches, and the gram is what is seen from there.
    # The pattern is also tried within characters beyond U+FFFF, where none begins.
    begin = f"(?s)(?=([^\\x{{DC00}}-\\x{{DFFF}}].{{{GRAM - 1}}}))"
    grams = F.regexp_extract_all(F.col(text), F.lit(begin), F.lit(1))
    whole = F.length(text) <= GRAM
    rows = rows.withColumn("_g", F.when(whole, F.array(text)).otherwise(grams))
    last = F.lit(_LOW).cast("long") - at

    def mark(gram: Column, i: Column) -> Column:
        bits = F.shiftleft(F.xxhash64(gram), 31).bitwiseAND(F.lit(_HIGH))
        return bits.bitwiseOR(last - i)

    rows = rows.withColumn("_grams", F.transform("_g", mark)).drop("_g")
    rows = rows.withColumn("_least", F.col("_grams"))
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        rows = _folded(rows, "_least", step, lambda a, b: F.least(a, b))
        width += step
    whole = F.greatest(F.size("_grams") - (WINDOW - 1), F.lit(0))
    return rows.withColumn("_least", F.slice("_least", F.lit(1), whole))


def _chosen(text: str) -> Column:
    """The marks of a whole text that has its hashes."""
    none = F.array().cast("array<bigint>")
    least = F.array_distinct("_least")
    found = F.when(F.size("_grams") < FEW, F.col("_grams")).otherwise(least)
    return F.when(F.col(text) == "", none).otherwise(found)


def with_marks(rows: DataFrame, text: str, marks: str) -> DataFrame:
    """Adds the marks of a text column, in the order of their positions."""
    rows = rows.withColumn("_t", _trimmed(F.col(text)))
    rows = _with_hashes(rows, "_t", F.lit(0))
    return rows.withColumn(marks, _chosen("_t")).drop("_t", "_grams", "_least")


def mark_positions(marks: Column) -> Column:
    """The marks as an array of (position, hash)."""
    return F.transform(
        marks,
        lambda m: F.struct(
            (F.lit(_LOW) - m.bitwiseAND(F.lit(_LOW))).alias("position"),
            F.shiftright(m, 31).alias("hash"),
        ),
    )


def fingerprint(marks: Column) -> Column:
    """A text that equal marks share: 128 bits of all hashes and positions."""
    halves = [F.xxhash64(F.lit(seed), marks) for seed in (1, 2)]
    return F.lower(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in halves]))


def likeness(left: Column, right: Column) -> Column:
    """Shared hashes among all hashes of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _hashes(marks: Column) -> Column:
    return F.array_distinct(F.transform(marks, lambda m: F.shiftright(m, 31)))


def _id_ranges(ids: DataFrame) -> Column:
    """A column over ``key`` that numbers ranges of ids of about RANGE_ROWS rows, in order.

    Quantiles split the ids, and equal steps each part between two quantiles. Ids of
    any distribution come out right; the quantiles keep the ranges even.
    """
    marks = [i / _QUANTILES for i in range(1, _QUANTILES)]
    known = ids.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.percentile_approx("key", marks, 1000).alias("cuts"),
    ).first()
    if not known["rows"]:
        return F.lit(0)
    bounds = sorted({known["low"], *known["cuts"], known["high"]})
    parts = max(1, -(-known["rows"] // (RANGE_ROWS * max(1, len(bounds) - 1))))
    limits = F.array(*[F.lit(b).cast("long") for b in bounds])
    at = F.size(F.filter(limits, lambda b: b <= F.col("key")))
    low = F.get(limits, at - 1).cast("double")
    high = F.coalesce(F.get(limits, at).cast("double"), low + 1)
    step = F.floor((F.col("key").cast("double") - low) / (high - low) * parts)
    return at * F.lit(parts) + F.least(step, F.lit(parts - 1))


def _with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows in ranges of ids, and the order in which each row's next one follows it.

    Each range also gets, as a guest, the row that follows its last one: the first row of
    the next lower range, or of the highest range for the lowest.
    """
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    keyed = rows.withColumn("range", _id_ranges(rows.select("key")))
    tops = keyed.groupBy("range").agg(F.max("key").alias("key"))
    upward = Window.orderBy("range")
    lowest = F.min("range").over(Window.partitionBy())
    guests = tops.select(
        "range", "key", F.coalesce(F.lead("range").over(upward), lowest).alias("target")
    )
    stays = F.struct(F.col("range"), F.lit(0).alias("guest"))
    visits = F.struct(F.col("target").alias("range"), F.lit(1).alias("guest"))
    placed = keyed.join(guests, ["range", "key"], "left").select(
        "doc_id",
        "key",
        "text",
        F.explode(
            F.when(F.col("target").isNull(), F.array(stays)).otherwise(F.array(stays, visits))
        ).alias("place"),
    )
    order = Window.partitionBy("range").orderBy("guest", F.desc("key"), "text")
    return placed.select("doc_id", "key", "text", "place.range", "place.guest"), order


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's marks, its edited text and that one's marks, and both likenesses.

    The edited text has the last half of the characters replaced by as many of the first
    of the next document, by falling id and from the last one on to the first. Its windows
    within either part are those of the two documents; only what lies across the seam and at
    the cut is hashed anew.
    """
    rows, order = _with_next(docs)
    # Rows are in their ranges from here on, so that only texts are shuffled.
    rows = rows.withColumn("_next_text", F.lead("text").over(order))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    # What stays of a text begins the edited text, and its windows are those of the text
    # itself, but for the last characters: there the next text may be seen.
    rows = rows.withColumn("_kept", F.substring(F.col("text"), F.lit(1), n - half))
    rows = rows.withColumn("_t", _trimmed(F.col("text"))).withColumn("_k", _trimmed(F.col("_kept")))
    shared = F.length("_k") - _SEAM
    rows = rows.withColumn("_at", F.when(shared >= FEW, shared).otherwise(F.lit(0)))
    rows = _with_hashes(rows, "_t", F.lit(0))
    ends_in_space = F.btrim(F.substring("_kept", -1, 1), F.lit(_SPACE)) == ""
    rows = rows.select(
        "doc_id",
        "key",
        "text",
        "range",
        "guest",
        "_next_text",
        "_at",
        F.concat(
            F.when(F.col("_at") == 0, F.col("_kept")).otherwise(F.right("_k", F.lit(_SEAM))),
            F.when((F.col("_at") > 0) & ends_in_space, F.lit(" ")).otherwise(F.lit("")),
        ).alias("_seam"),
        _chosen("_t").alias("marks"),
        F.array_distinct(F.slice("_least", F.lit(1), F.col("_at"))).alias("_before"),
    )
    rows = rows.withColumn("_own", _hashes(F.col("marks")))
    rows = rows.withColumn("_next", F.lead("_own").over(order))
    rows = rows.withColumn("_next_marks", F.lead("marks").over(order)).where("guest = 0")
    new = F.substring(F.col("_next_text"), F.lit(1), half)
    rows = rows.withColumn("_new", new).withColumn("_rest", _spaced(F.concat("_seam", "_new")))
    # The seam may begin with a space that stands within the edited text.
    trimmed = F.rtrim(F.col("_rest"), F.lit(" "))
    rows = rows.withColumn(
        "_rest", F.when(F.col("_at") == 0, F.ltrim(trimmed, F.lit(" "))).otherwise(trimmed)
    )
    # Behind the seam and a space, if any, the next text begins; it has its windows' marks
    # if it keeps as many grams as a text that does not have all of them as marks.
    begins = _SEAM + (F.substring("_rest", _SEAM + 1, 1) == " ").cast("int")
    rows = rows.withColumn("_begins", begins)
    # Each is used several times below: what is used once would be put into a function of
    # elements, and then be found anew for each element.
    rows = rows.withColumn("_taken", (F.length("_rest") - F.col("_begins")).cast("long"))
    rows = rows.withColumn("_moved", (F.col("_at") + F.col("_begins")).cast("long"))
    far = (F.col("_at") > 0) & (F.col("_taken") >= FEW + GRAM - 1)
    # A mark is the beginning's own if even the last window that it could begin is whole there.
    whole = F.lit(_LOW + GRAM + WINDOW - 1)
    own = F.filter("_next_marks", lambda m: m.bitwiseAND(F.lit(_LOW)) + F.col("_taken") >= whole)
    rows = rows.select(
        "*",
        F.when(far, F.transform(own, lambda m: m - F.col("_moved")))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_body"),
        F.when(far, F.right("_rest", F.lit(_TAIL))).otherwise("").alias("_tail"),
        (F.col("_moved") + F.col("_taken") - _TAIL).alias("_tail_at"),
        F.when(far, F.left("_rest", F.col("_begins") + _SEAM))
        .otherwise(F.col("_rest"))
        .alias("_across"),
    )
    rows = _with_hashes(rows, "_tail", F.col("_tail_at")).withColumnRenamed("_least", "_end")
    rows = _with_hashes(rows.drop("_grams"), "_across", F.col("_at"))
    joined = F.array_distinct(F.concat("_before", "_least", "_body", "_end"))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - half), "_new").alias("edited"),
        "marks",
        F.when(F.col("_at") == 0, _chosen("_across")).otherwise(joined).alias("edited_marks"),
        "_own",
        "_next",
    )
    rows = rows.withColumn("_edited", _hashes(F.col("edited_marks")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "marks",
        "edited_marks",
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
