"""Benchmark decontamination by templates, with DataFrame functions only.

Numbers, names and units become typed placeholders, other words lose case and edge punctuation; one word stays one word, so a
place in the template is the same place in the text. Windows of `width` template words of documents meet those of benchmark items by
their text. Only documents that share a shorter block with an item window, at every fourth place, have their windows listed: each window of eight words holds such a block
of four whole. A document holds an item when enough of the item's windows are found and the words behind the placeholders change
consistently: each word of the item stands for one word of the document throughout, and no two of them for the same one.

A capitalised word at the start of a sentence may be a name or not, so windows with such words are compared both ways. Item windows of too
few plain words are compared by their words as they are, so that copies are found and loose templates are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage

WIDTH = 8
MIN_SHARE = 0.5  # of an item's windows
MIN_CONSISTENT = 0.8  # of the placeholders' words
MIN_PLAIN = 4  # words of a window that are no placeholders
BROADCAST_WINDOWS = 2_000_000
BROADCAST_DOCS = 200_000  # keys of documents
# Placeholders, one private character each, and the words taken as units after a number.
NUMBER, NAME, UNIT = "\ue001", "\ue002", "\ue003"
INITIAL = "\ue004"  # goes before a word that is a name or the first of a sentence
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml l s sec min h hr day days week weeks month months year years hour hours minute minutes "
    "second seconds meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram kilograms pound "
    "pounds liter liters litre litres dollar dollars cent cents euro euros percent degree degrees"
).split()
# Words that are no names at the start of a sentence either.
NO_NAMES = (
    "a an the this that these those he she it we you they his her its our your their who whom whose what which when where why how if in on "
    "at by for from of to with after before and but or so then is are was were do does did can could will would there each every all some"
).split()
INNER = r"[\p{L}\p{N}\x{E001}-\x{E004}]"
EDGE = r"[^\p{L}\p{N}\s\x{E001}-\x{E004}]"


def spaced(text: Column) -> Column:
    """White space as single blanks, none at the ends."""
    # a lone blank, by far the most frequent run, is no match
    odd, white = r"[\t-\r\x{E001}-\x{E004}]", r"[ \t-\r\x{E001}-\x{E004}]"
    return F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), rf" *{odd}{white}*+|  ++{white}*+", " "))


def literal(text: Column) -> Column:
    """The words of a spaced text in lower case and without punctuation at their edges."""
    return F.lower(F.regexp_replace(text, rf"(?={EDGE})(?:(?<={INNER}){EDGE}++(?!\S)|(?<!\S){EDGE}++(?={INNER}))", ""))


def template(text: Column) -> Column:
    """The template of a spaced text, with as many words; `INITIAL` stands before words that may be names."""
    out = F.regexp_replace(text, r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;] )\p{Lu}\p{L}+", NAME)
    out = F.regexp_replace(out, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?!(?i:{'|'.join(NO_NAMES)})(?!\p{{L}}))\p{{Lu}}\p{{L}}+", f"{INITIAL}$0")
    numbered = F.regexp_replace(out, r"(?<!\S)[^\p{L}\p{N}\s]*+\p{N}[\p{N}.,:/]*+[^\p{L}\p{N}\s]*+(?!\S)", NUMBER)
    numbered = F.regexp_replace(numbered, rf"(?<={NUMBER} ){INITIAL}?(?i:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", UNIT)
    out = F.when(out.rlike(r"\p{N}"), numbered).otherwise(out)
    return literal(out)


def windows(template_text: Column, width: int) -> Column:
    """All windows of `width` words, by place; a text of fewer words has none."""
    # a window is looked at ahead of its first word, and the search goes on behind that word
    pattern = rf"(?=([^ ]++(?: [^ ]++){{{width - 1}}}))[^ ]++"
    return F.regexp_extract_all(template_text, F.lit(pattern), 1)


def blocks(text: Column, size: int) -> Column:
    """The words of a text in blocks of `size`, one behind the other; words left over at the end have none."""
    return F.regexp_extract_all(text, F.lit(rf"[^ ]++(?: [^ ]++){{{size - 1}}}"), 0)


def _block_size(width: int) -> int:
    """The largest size of which each window of `width` words holds a whole block, wherever it starts."""
    return (width + 1) // 2


def _anchored(window: Column, width: int, min_plain: int) -> Column:
    """True for a window with enough plain words; the hash of it is what is joined."""
    filled = F.length(window) - F.length(F.translate(window, NUMBER + NAME + UNIT, ""))
    return width - filled >= min(min_plain, width)


def _named(text: Column) -> Column:
    return F.regexp_replace(text, rf"{INITIAL}\p{{L}}+", NAME)


def _plain(text: Column) -> Column:
    return F.translate(text, INITIAL, "")


def _readings(window: Column) -> Column:
    """A window of a document with all its initial words as names, and with none."""
    return F.when(F.contains(window, F.lit(INITIAL)), F.array(_plain(window), _named(window))).otherwise(F.array(window))


def _all_readings(window: Column) -> Column:
    """A window of an item with each of its initial words as a name or not."""

    def step(done: Column, word: Column) -> Column:
        return F.flatten(F.transform(_readings(word), lambda w: F.transform(done, lambda d: F.concat_ws(" ", d, w))))

    words = F.split(window, " ")
    return F.aggregate(F.slice(words, 2, F.size(words)), _readings(F.element_at(words, 1)), step)


def text_keys(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two hashes that rows alike in id and text share."""
    doc_id, own = doc_id.cast("long"), F.coalesce(text.cast("string"), F.lit(""))
    return F.xxhash64(doc_id, own), F.xxhash64(own, doc_id, F.lit(1))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, min_share: float = MIN_SHARE, min_consistent: float = MIN_CONSISTENT,
    min_plain: int = MIN_PLAIN, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, share of the item's windows found, share of consistent placeholder words, and `text_keys`, for each held item.

    An item of fewer than `width` words is one window of its own length, matched at that length. A window of fewer than `min_plain` plain
    words matches its own words alone; the share is that of all windows or of the others, whichever is larger. NULL or empty items match nothing, and
    so do NULL or empty texts. Rows alike in id and text give one row per item; a NULL id stays NULL. Repeated items count as one.
    Other columns are ignored. An empty table on either side gives an empty result.
    """
    text = spaced(docs[text_col])
    k1, k2 = text_keys(docs[id_col], docs[text_col])  # keys need no spacing, so that is done once, for the windows
    keyed = docs.select(docs[id_col].cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), text.alias("raw"))
    items = (
        benchmark.select(benchmark[item_col].alias("item_id"), spaced(benchmark[item_text_col]).alias("raw")).where("raw <> ''").distinct()
        .withColumn("template", template(F.col("raw")))
        .withColumn("size", F.least(F.lit(width), F.size(F.split("raw", " "))))
    )
    sizes = sorted(n for (n,) in items.select("size").distinct().collect())  # at most `width` numbers
    if not sizes:
        return keyed.select("doc_id", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0.0).alias("share"), F.lit(0.0).alias("consistent"), "k1", "k2").limit(0)
    both = lambda n: F.zip_with(windows(template(F.col("raw")), n), windows(literal(F.col("raw")), n), lambda t, w: F.struct(t.alias("t"), w.alias("w")))
    item_windows = cut_lineage(_stack([
        items.where(F.col("size") == n).select("item_id", F.lit(n).alias("size"), F.posexplode(both(n)).alias("at", "x"))
        .withColumn("loose", F.filter(_all_readings(F.col("x.t")), lambda w: _anchored(w, n, min_plain)))  # noqa: B023
        # a blank before the words tells them from templates
        .withColumn("window", F.explode(F.when(F.size("loose") > 0, F.array_distinct("loose")).otherwise(F.array(F.concat(F.lit(" "), "x.w")))))
        .select("item_id", "size", "at", "window")
        for n in sizes
    ]))
    exact = F.col("window").startswith(" ")
    exact_sizes = sorted(n for (n,) in item_windows.where(exact).select("size").distinct().collect())
    known = item_windows.groupBy("size", "window").agg(F.xxhash64("window").alias("h")).select("size", "h", "window")
    if known.count() <= BROADCAST_WINDOWS:
        known = F.broadcast(known)

    keyed = touched(keyed, item_windows)

    def search(n: int, places: Column, forms: Column) -> DataFrame:
        return (
            keyed.select("doc_id", "k1", "k2", F.posexplode(places).alias("place", "window")).withColumn("window", F.explode(forms))
            .withColumn("h", F.xxhash64("window")).join(known.where(F.col("size") == n).withColumnRenamed("window", "same"), "h")
            .where("window = same").select("doc_id", "k1", "k2", "place", "size", "window")
        )

    found = cut_lineage(_stack([
        *(search(n, windows(template(F.col("raw")), n), _readings(F.col("window"))) for n in sizes),
        *(search(n, windows(literal(F.col("raw")), n), F.array(F.concat(F.lit(" "), "window"))) for n in exact_sizes),
    ]))
    met = found.join(item_windows.select("item_id", "at", "size", "window"), ["size", "window"])
    counted = lambda name: (F.countDistinct("at").alias(name), F.countDistinct(F.when(~exact, F.col("at"))).alias(f"{name}_loose"))
    of_item = item_windows.groupBy("item_id").agg(*counted("n_windows"))
    share = F.greatest(F.col("n_found") / F.col("n_windows"), F.when(F.col("n_windows_loose") > 0, F.col("n_found_loose") / F.col("n_windows_loose")))
    shares = (
        met.groupBy("doc_id", "k1", "k2", "item_id").agg(*counted("n_found"))
        .join(of_item, "item_id").withColumn("share", share).where(F.col("share") >= min_share)
    )
    slots = _slot_shares(met, keyed, items, item_windows)
    return (
        shares.join(slots, ["k1", "k2", "item_id"], "left").withColumn("consistent", F.coalesce("consistent", F.lit(1.0)))
        .where(F.col("consistent") >= min_consistent).select("doc_id", "item_id", "share", "consistent", "k1", "k2")
    )


def touched(keyed: DataFrame, item_windows: DataFrame) -> DataFrame:
    """The rows of `keyed` that share a block with a window of an item, in the same reading; no other row can hold such a window. Written once."""
    exact = F.col("window").startswith(" ")
    grouped: dict[tuple[int, bool], list[int]] = {}
    for n, literally in item_windows.select("size", exact).distinct().collect():  # at most two rows for each size
        grouped.setdefault((_block_size(n), literally), []).append(n)

    def met(size: int, literally: bool, widths: list[int]) -> DataFrame:
        known = (
            item_windows.where(F.col("size").isin(widths) & (exact == F.lit(literally)))
            .select(F.explode(windows(F.ltrim("window"), size)).alias("block")).select(F.xxhash64("block").alias("h")).distinct()
        )
        known = cut_lineage(known)
        if known.count() <= BROADCAST_WINDOWS:
            known = F.broadcast(known)
        text, forms = (literal(F.col("raw")), F.array("block")) if literally else (template(F.col("raw")), _readings(F.col("block")))
        return (
            keyed.select("k1", "k2", F.explode(blocks(text, size)).alias("block")).select("k1", "k2", F.explode(forms).alias("block"))
            .select("k1", "k2", F.xxhash64("block").alias("h")).join(known, "h", "left_semi").select("k1", "k2")
        )

    if not grouped:
        return keyed.limit(0)
    hits = cut_lineage(_stack([met(*key, widths) for key, widths in sorted(grouped.items())]).distinct())
    if hits.count() <= BROADCAST_DOCS:
        hits = F.broadcast(hits)
    return cut_lineage(keyed.join(hits, ["k1", "k2"], "left_semi"))


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _slot_shares(met: DataFrame, keyed: DataFrame, items: DataFrame, item_windows: DataFrame) -> DataFrame:
    """For windows with placeholders: the share of placeholder words whose most frequent counterpart is the one they have, of the worst kind and direction.

    Both directions count: a word of the item stands for one word of the document, and no two words of the item for the same one.

    Only places with a placeholder travel; the document's words are looked up in the rows of matched documents alone.
    """
    shift = F.col("place") - F.col("at")
    of_shift = Window.partitionBy("k1", "k2", "item_id", shift)
    best = Window.partitionBy("k1", "k2", "item_id", "place").orderBy(F.desc("n"), shift)
    # like sentences of one item have like templates: a place counts where most of the document's windows put it
    slotted = met.where(F.col("window").rlike(f"[{NUMBER}{NAME}{UNIT}]")).withColumn("n", F.count("*").over(of_shift)).withColumn("best", F.rank().over(best)).where("best = 1")
    steps = F.posexplode(F.split("window", " "))
    places = (
        slotted.select("k1", "k2", "item_id", "place", "at", steps.alias("step", "word"))
        .where(F.col("word").isin(NUMBER, NAME, UNIT))
        .select("k1", "k2", "item_id", "word", (F.col("place") + F.col("step")).alias("place"), (F.col("at") + F.col("step")).alias("at")).distinct()
    )
    item_words = items.select("item_id", F.posexplode(F.split("raw", " ")).alias("at", "item_word"))
    some = places.select("k1", "k2").distinct()
    doc_words = keyed.join(some, ["k1", "k2"], "left_semi").select("k1", "k2", "raw").distinct().select("k1", "k2", F.posexplode(F.split("raw", " ")).alias("place", "doc_word"))
    pairs = places.join(item_words, ["item_id", "at"]).join(doc_words, ["k1", "k2", "place"])
    plain = lambda c: F.lower(F.regexp_replace(c, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    counts = pairs.groupBy("k1", "k2", "item_id", "word", plain("item_word").alias("mine"), plain("doc_word").alias("theirs")).agg(F.count("*").alias("n"))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("mine").alias("value")), F.struct(F.lit(1).alias("side"), F.col("theirs").alias("value"))))
    keys = ["k1", "k2", "item_id", "word", "side"]
    per_word = counts.select(*keys[:4], "n", sides.alias("x")).select(*keys[:4], "n", "x.*").groupBy(*keys, "value").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    per_kind = per_word.groupBy(*keys).agg((F.sum("most") / F.sum("n")).alias("part"))
    return per_kind.groupBy("k1", "k2", "item_id").agg(F.min("part").alias("consistent"))
