"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Personal values (e-mail, ip, card, phone) are the protected entities. A word near a mention reveals its entity as far as
PMI(term; entity) = log2(c N / (df(term) df(entity))) reaches the entity's own information IC = log2(N / df(entity)):
the share PMI / IC is 1 for a term that never occurs without the entity. N, df and c count the different documents (id and text) of the
whole corpus, c those where the term stands within `reach` words of a mention. Words are runs without white space, of any length; the runs
that touch the mention are not counted. A mention is a word at least, also where several of one kind share a run. Terms with a share of at least `remove` are removed beside that
entity's mentions, those of at least `generalise` are generalised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage

# The kinds in their order, and the pattern of each.
# Possessive groups and the look-behind change no match; they keep long runs of one character class linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold before its kind is searched for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "removed", "generalised")
# Function words, which are no terms when in lower case; all others are, of any length.
FUNCTION_WORDS = "a an the and or but nor if as at by for from in into of off on onto out over per to up via with is are was were be been am do does did".split()
LETTERS = r"\p{L}+"
WORD = rf"(?<!\p{{L}})(?!(?:{'|'.join(FUNCTION_WORDS)})(?!\p{{L}}))\p{{L}}+"
MIN_SUPPORT = 2
REMOVE = 0.8
GENERALISE = 0.6
REACH = 5
BROADCAST_KEYS = 1_000_000  # keys of repeated rows, 24 bytes each
WIDTHS = (300, 20_000)  # characters beside a mention that are looked at first; the rest only where they do not hold its words


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


MENTION = "array<struct<kind:int,s:int,e:int,value:string,left:string,right:string>>"


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _first_whole(make, is_whole) -> Column:
    """The first of the stretches `make(width)` that is whole; the last width has no limit."""
    def or_wider(width: int, wider: Column) -> Column:
        return _let(make(width), lambda x: F.when(is_whole(x), x).otherwise(wider))

    out = make(None)
    for width in reversed(WIDTHS):
        out = or_wider(width, out)
    return out


def _mentions(text: Column, kind: str, reach: int) -> Column:
    """Valid matches of one kind with their places, by one walk over matches and the gaps between them, and the `reach` words on each side."""
    pattern, number = PATTERNS[kind], list(PATTERNS).index(kind)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    steps = F.zip_with(gaps, F.regexp_extract_all(text, F.lit(pattern), 0), lambda n, v: F.struct(n.alias("n"), v.alias("v")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,value:string>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + x["n"]
        end = begin + F.coalesce(F.length(x["v"]), F.lit(0))
        match = F.struct(begin.alias("s"), end.alias("e"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["v"].isNull(), a["out"]).otherwise(F.array_append(a["out"], match)).alias("out"))

    def beside(all_found: Column, m: Column, i: Column) -> Column:
        # no word is looked for beyond as many mentions as words, so a place in the text is looked at for a fixed number of mentions
        low = F.coalesce(F.get(all_found, i - reach - 1)["e"], F.lit(0))
        high = F.coalesce(F.get(all_found, i + reach + 1)["s"], F.length(text))

        def left(width):
            begin = low if width is None else F.greatest(low, m["s"] - width)
            return F.struct((begin == low).alias("all"), F.substring(text, begin + 1, m["s"] - begin).alias("text"))

        def right(width):
            end = high if width is None else F.least(high, m["e"] + width)
            return F.struct((end == high).alias("all"), F.substring(text, m["e"] + 1, end - m["e"]).alias("text"))

        before = _first_whole(left, lambda x: x["all"] | x["text"].rlike(rf"\s(?:\S++\s++){{{reach}}}\S*+$"))
        after = _first_whole(right, lambda x: x["all"] | x["text"].rlike(rf"^\S*+(?:\s++\S++){{{reach}}}\s"))
        return F.struct(
            F.lit(number).alias("kind"), m["s"].alias("s"), m["e"].alias("e"), m["value"].alias("value"),
            F.regexp_extract(before["text"], rf"(?<!\S)(?:\S++\s++){{0,{reach}}}\S*+$", 0).alias("left"),
            F.regexp_extract(after["text"], rf"^\S*+(?:\s++\S++){{0,{reach}}}", 0).alias("right"),
        )

    found = F.filter(F.aggregate(steps, start, step, lambda a: a["out"]), lambda m: _valid(kind, m["value"]))
    with_sides = _let(found, lambda ms: F.transform(ms, lambda m, i: beside(ms, m, i)))
    return F.when(text.rlike(HINTS[kind]), with_sides).otherwise(F.array()).cast(MENTION)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, a 128-bit key of id and text, and the text, a NULL one as empty; rows alike in id and text share a key."""
    doc_id, text = docs[id_col].cast("long"), F.coalesce(docs[text_col].cast("string"), F.lit(""))
    k1, k2 = F.xxhash64(doc_id, text), F.xxhash64(text, doc_id, F.lit(1))
    return docs.select(doc_id.alias("doc_id"), k1.alias("k1"), k2.alias("k2"), text.alias("text"))


def base_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """doc_id, key, and the mentions by kind; rows alike in id and text share a key and a result."""
    return _keyed(docs, id_col, text_col).select(
        "doc_id", "k1", "k2", *(_mentions(F.col("text"), kind, reach).alias(kind) for kind in PATTERNS)
    )


def _words_beside(side: Column, begin: Column) -> Column:
    """Words of a stretch of text that begins at `begin`, lower-cased, with their places."""
    steps = F.zip_with(F.split(side, WORD, -1), F.regexp_extract_all(side, F.lit(WORD), 0), lambda g, v: F.struct(F.length(g).alias("n"), v.alias("v")))
    kind = "array<struct<term:string,s:int,e:int>>"

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + x["n"]
        e = s + F.coalesce(F.length(x["v"]), F.lit(0))
        word = F.struct(F.lower(x["v"]).alias("term"), s.alias("s"), e.alias("e"))
        return F.struct(e.alias("at"), F.when(x["v"].isNull(), a["out"]).otherwise(F.array_append(a["out"], word)).alias("out"))

    return F.aggregate(steps, F.struct(begin.cast("int").alias("at"), F.array().cast(kind).alias("out")), step, lambda a: a["out"])


def terms_beside(base: DataFrame) -> DataFrame:
    """One row per mention and word within reach, over line breaks and other mentions: key, entity, term and the word's place."""
    one = base.select("k1", "k2", F.explode(F.concat(*PATTERNS)).alias("m")).select(
        "k1", "k2", F.concat(F.col("m.kind").cast("string"), F.lit(":"), F.lower("m.value")).alias("entity"), "m.s", "m.e",
        "m.left", "m.right",
    )
    sides = F.concat(_words_beside(F.col("left"), F.col("s") - F.length("left")), _words_beside(F.col("right"), F.col("e")))
    return one.select("k1", "k2", "entity", F.explode(sides).alias("w")).select("k1", "k2", "entity", "w.term", "w.s", "w.e")


def _document_counts(keyed: DataFrame, rows_of: DataFrame) -> DataFrame:
    """(term, df_term): in how many different documents a word occurs.

    All rows are counted, and those beyond the first of a document are taken off again, so only the words of repeated rows are
    brought together by document.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), 0))
    counted = keyed.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    repeated = rows_of.where("rows > 1")
    if not (many := repeated.count()):
        return counted.withColumnRenamed("n", "df_term")
    if many <= BROADCAST_KEYS:
        repeated = F.broadcast(repeated)
    again = keyed.join(repeated, ["k1", "k2"]).select("k1", "k2", "rows", words.alias("words")).dropDuplicates(["k1", "k2"])
    less = again.select(F.explode("words").alias("term"), "rows").groupBy("term").agg(F.sum(1 - F.col("rows")).alias("n"))
    return counted.unionByName(less).groupBy("term").agg(F.sum("n").alias("df_term"))


def disclosures(
    base: DataFrame, beside: DataFrame, docs: DataFrame, *, min_support: int = MIN_SUPPORT, remove: float = REMOVE,
    generalise: float = GENERALISE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(entity, term, action) for terms whose share of the entity's information passes a threshold."""
    rows_of = cut_lineage(base.groupBy("k1", "k2").agg(F.count("*").alias("rows")))
    n_docs = rows_of.count()
    together = beside.select("entity", "term", "k1", "k2").distinct().groupBy("entity", "term").agg(F.count("*").alias("c")).where(F.col("c") >= min_support)
    with_entity = (
        base.select("k1", "k2", F.explode(F.concat(*PATTERNS)).alias("m"))
        .select(F.concat(F.col("m.kind").cast("string"), F.lit(":"), F.lower("m.value")).alias("entity"), "k1", "k2").distinct()
        .groupBy("entity").agg(F.count("*").alias("df_entity"))
    )
    with_term = _document_counts(_keyed(docs, id_col, text_col), rows_of)
    content = F.log2(F.lit(float(n_docs)) / F.col("df_entity"))
    shared = F.log2(F.col("c") * F.lit(float(n_docs)) / (F.col("df_term") * F.col("df_entity")))
    share = F.when(content > 0, shared / content)
    removed, generalised = KINDS.index("removed"), KINDS.index("generalised")
    scored = together.join(with_entity, "entity").join(with_term, "term").select("entity", "term", share.alias("share"))
    return scored.where(F.col("share") >= min(remove, generalise)).select(
        "entity", "term", "share", F.when(F.col("share") >= remove, removed).otherwise(generalised).alias("action")
    )


SPAN = "array<struct<s:int,kind:int,e:int>>"


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, and all spans as text and as an array `found`.

    A NULL or empty text has no spans. A NULL id stays NULL. Rows alike in id and text get the same result each and count as one
    document everywhere. Other columns are ignored; an empty table gives an empty result. A term inside a base span is not
    reported; one that is both removed and generalised is removed.
    """
    base = cut_lineage(base_mentions(docs, id_col, text_col))
    beside = terms_beside(base)
    actions = disclosures(base, beside, docs, id_col=id_col, text_col=text_col, **thresholds)
    marked = (
        beside.join(actions, ["entity", "term"]).groupBy("k1", "k2", "s", "e").agg(F.min("action").alias("kind"))
        .groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "kind", "e")).alias("terms"))
    )
    own = F.transform(F.concat(*PATTERNS), lambda m: F.struct(m["s"].alias("s"), m["kind"].alias("kind"), m["e"].alias("e")))
    joined = base.select("doc_id", "k1", "k2", *(F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS), own.alias("own")).join(marked, ["k1", "k2"], "left")
    outside = F.filter(
        F.coalesce("terms", F.array().cast(SPAN)), lambda t: ~F.exists("own", lambda b: (t["s"] < b["e"]) & (t["e"] > b["s"]))
    )
    return joined.select(
        "doc_id", *(f"n_{k}" for k in PATTERNS), F.sha2(_joined(F.col("own")), 256).alias("base_sha256"),
        _joined(F.concat("own", outside)).alias("spans"), F.array_sort(F.concat("own", outside)).alias("found"), "k1", "k2",
    )


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """doc_id and text with personal values replaced by their kind, revealing terms removed or generalised to `[term]`."""
    found = find_personal_data(docs, id_col=id_col, text_col=text_col, **thresholds).select("k1", "k2", "found").dropDuplicates(["k1", "k2"])
    keyed = _keyed(docs, id_col, text_col)
    labels = F.array(*(F.lit(f"[{k}]") for k in PATTERNS), F.lit(""), F.lit("[term]"))

    def step(a: Column, x: Column) -> Column:
        past = F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["out"].alias("out"))
        kept = F.substring(F.col("text"), a["at"] + 1, x["s"] - a["at"])
        return F.when(x["s"] < a["at"], past).otherwise(
            F.struct(x["e"].alias("at"), F.concat(a["out"], kept, F.element_at(labels, x["kind"] + 1)).alias("out"))
        )

    whole = F.aggregate(
        "found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    return keyed.join(found, ["k1", "k2"]).select("doc_id", whole.alias("text"))
