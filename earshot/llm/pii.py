"""Personal data by pattern, and terms that disclose it by their co-occurrence in the corpus.

DataFrame functions only. Texts without ``@``, ``+`` or digits never reach a pattern.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import forget, parted, settle, sieve

KINDS = ("email", "ip", "card", "phone")
#: The kinds' patterns, written so that each run of characters is tried once and repeated groups
#: are possessive: equal matches, but linear time and constant stack on any text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){12}", "phone": "\\+[0-9]"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
LETTERS = r"[^\p{L}]+"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"

#: Cells of the count of words; times the mean of these from which a cell is crowded.
CELLS, CROWDED = 1 << 17, 8
#: Words on each side of a mention that count as its context: as many as a document can hold.
REACH = 2**31 - 1
#: Shortest term; documents in which a term must stand near an entity; share of the entity's
#: information content that a term may disclose.
MIN_LETTERS, MIN_SUPPORT, DISCLOSURE = 1, 2, 0.9


def _luhn(digits: Column) -> Column:
    """Check sum of a digit string, from the right, every second digit doubled."""
    from_right = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda s, i: s + _luhn_digit(F.substr(from_right, i, F.lit(1)).cast("int"), i % 2 == 0),
    )
    return total % 10 == 0


def _luhn_digit(digit: Column, doubled: Column) -> Column:
    twice = digit * 2
    return F.when(~doubled, digit).when(twice > 9, twice - 9).otherwise(twice)


def _holds(kind: str, value: Column) -> Column:
    """What a match must meet beside its pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.length(digits).between(13, 19) & _luhn(digits)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda span: _holds(kind, span["value"])


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), LETTERS), lambda w: F.length(w) >= MIN_LETTERS)


def _context(text: Column) -> Column:
    """The distinct words of a text outside its protected values; only addresses have letters."""
    return F.array_distinct(_words(F.regexp_replace(text, PATTERNS["email"], " ")))


def _located(text: Column, hits: Column, pattern: Column, kind: Column) -> Column:
    """Matches with their offsets: the lengths of what lies between them, summed up."""
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(hits)).alias("before"),
        hits.alias("value"),
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["before"])
        end = start + F.length(x["value"])
        span = F.struct(kind.alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["found"], span).alias("found"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))
    return F.aggregate(zipped, empty, step, lambda s: s["found"])


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Rows as (doc_id, text, row): identical rows share the key ``row``, others don't."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.col(id_col).cast("long")
    key = F.struct(F.coalesce(number, F.lit(-(2**63))).alias("id"), F.xxhash64(text).alias("hash"))
    return docs.select(number.alias("doc_id"), text.alias("text"), key.alias("row"), *more)


def _with_base(df: DataFrame) -> DataFrame:
    """``df``, which has the column text, with ``base``: valid matches by kind as in KINDS, then start."""
    text = F.col("text")
    none = F.array().cast("array<string>")
    hits = df.select(
        "*",
        *(
            F.when(text.rlike(HINTS[k]), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0)))
            .otherwise(none)
            .alias(f"hits_{k}")
            for k in KINDS
        ),
    )
    found = [
        F.when(
            F.size(f"hits_{k}") > 0,
            F.filter(_located(text, F.col(f"hits_{k}"), F.lit(PATTERNS[k]), F.lit(k)), _check(k)),
        ).otherwise(F.array().cast(SPAN))
        for k in KINDS
    ]
    return hits.select(*df.columns, F.concat(*found).alias("base"))


def base_spans(keyed: DataFrame) -> DataFrame:
    """(doc_id, row, base) of every row."""
    return _with_base(keyed).select("doc_id", "row", "base")


def _entity() -> Column:
    """A mention's entity: its kind and value without case and separators."""
    value = F.col("m.value")
    bare = F.when(F.col("m.kind").isin("card", "phone"), F.regexp_replace(value, "[^0-9]", "")).otherwise(F.lower(value))
    return F.concat_ws(":", "m.kind", bare)


def disclosing_terms(keyed: DataFrame, base: DataFrame, support: int, disclosure: float, written: list[str] | None = None) -> DataFrame:
    """(row, terms): per row the terms in it that disclose a protected entity of the corpus.

    With N documents, n_e of which mention entity e, n_t hold term t and n_te hold both, t outside of
    protected values, PMI(e; t) = log(N n_te / (n_e n_t)) is what t tells about e, and
    IC(e) = log(N / n_e) all there is to tell. A term discloses e from PMI / IC = ``disclosure`` on, if
    n_te >= ``support``.

    n_te is at most n_e, so entities of fewer documents play no part, and each of the others bounds the
    n_t of its terms. Words travel as hashes with their row, once, and meet the entities of their row only
    if they are within the bound of one. The words of crowded hash cells, the common ones among them,
    are counted before they are shuffled. The candidates' n_t are counted in the tasks that read the texts;
    rows are listed only for terms that pass, so common words never travel by row.
    """
    mentions = settle(base.select("row", F.explode("base").alias("m")).select("row", F.xxhash64(_entity()).alias("entity")).distinct(), "mentions", written)
    total = keyed.select("row").count()
    # PMI / IC >= disclosure, solved for n_t.
    bound = lambda n_te: F.col(n_te) * F.pow(F.lit(float(total)) / F.col("n_e"), F.lit(1 - disclosure))
    per_entity = mentions.groupBy("entity").agg(F.count("*").alias("n_e")).filter((F.col("n_e") >= support) & (F.col("n_e") < total))
    named = settle(mentions.join(per_entity.withColumn("bound", bound("n_e")), "entity"), "named", written)
    limit = named.agg(F.max("bound")).first()[0] or 0.0
    by_row = named.groupBy("row").agg(F.collect_list(F.struct("entity", "n_e", "bound")).alias("entities"))
    texts = sieve(keyed.select("row", "text"), named, "row").join(named.select("row").distinct(), "row", "left_semi")
    near = settle(texts.dropDuplicates(["row"]).select("row", _context(F.col("text")).alias("words")), "contexts", written)

    words = near.select("row", F.explode(F.transform("words", lambda w: F.xxhash64(w))).alias("hash"))
    cell = F.pmod("hash", F.lit(CELLS)).cast("int")
    cells = settle(words.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")), "cells", written)
    crowd = cells.filter(F.col("n") > CROWDED * (cells.agg(F.avg("n")).first()[0] or 0.0)).select("cell")
    split = words.withColumn("cell", cell)
    # Documents with the term and any entity bound n_t from below.
    few = (F.col("least") >= support) & (F.col("least") <= F.lit(limit))
    counted = lambda df: df.groupBy("hash").agg(F.count("*").alias("least")).filter(few)
    # One exchange serves the count and the rows.
    calm = split.join(F.broadcast(crowd), "cell", "left_anti").select("row", "hash").repartition("hash")
    loud = split.join(F.broadcast(crowd), "cell", "left_semi").select("row", "hash")
    usual = settle(counted(loud), "usual", written)
    spread = calm.join(counted(calm), "hash").unionByName(sieve(loud, usual, "hash").join(usual, "hash").select("hash", "row", "least"))
    fits = F.filter("entities", lambda e: F.col("least") <= e["bound"])
    pairs = (
        spread.join(by_row, "row")
        .select("hash", "least", F.explode(fits).alias("e"))
        .groupBy("hash", "least", F.col("e.entity").alias("entity"), F.col("e.n_e").alias("n_e"))
        .agg(F.count("*").alias("n_te"))
        .filter(F.col("n_te") >= support)
    )
    candidates = settle(
        pairs.groupBy("hash", "least").agg(F.max(bound("n_te")).alias("most")).filter("least <= most").select("hash", "most"),
        "candidates",
        written,
    )
    terms = lambda df: df.select("row", F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).withColumn("hash", F.xxhash64("term"))
    n_t = sieve(terms(_once(keyed, written)), candidates, "hash").groupBy("term", "hash").agg(F.count("*").alias("n_t"))
    told = settle(n_t.join(candidates, "hash").filter("n_t <= most").select("term", "hash"), "counted", written)
    held = sieve(terms(keyed), told, "hash").join(told.select("term"), "term")
    return held.groupBy("row").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _once(keyed: DataFrame, written: list[str] | None) -> DataFrame:
    """(row, text) of the distinct rows; only texts that pass a filter on the keys of repeated rows are shuffled."""
    repeated = settle(keyed.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1").select("row"), "repeated", written)
    double, single = parted(keyed.select("row", "text"), repeated, "row")
    return single.unionByName(double.dropDuplicates(["row"]))


def _with_terms(df: DataFrame, told: DataFrame) -> DataFrame:
    """``df`` (with text and row) with ``terms``: the places of its row's disclosing terms, as whole words.

    Case doesn't matter. Only rows that pass a filter on the key of rows with terms are shuffled.
    """
    may, free = parted(df, told, "row")
    free = free.withColumn("terms", F.array().cast(SPAN))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("_terms", "|"), F.lit(r")(?!\p{L})"))
    named = told.withColumnRenamed("terms", "_terms")
    hits = (
        may.join(named, "row", "left")
        .withColumn("_pattern", pattern)
        .withColumn("_hits", F.regexp_extract_all("text", F.col("_pattern"), F.lit(0)))
    )
    places = _located(F.col("text"), F.col("_hits"), F.col("_pattern"), F.lit("term"))
    met = hits.withColumn("terms", F.when(F.col("_pattern").isNull(), F.array().cast(SPAN)).otherwise(places))
    return met.select(*free.columns).unionByName(free)


def _told(keyed: DataFrame, support: int, disclosure: float) -> DataFrame:
    """The disclosing terms of each row, written; what led to them is removed again."""
    written: list[str] = []
    base = settle(base_spans(keyed), "base", written)
    told = settle(disclosing_terms(keyed, base, support, disclosure, written), "told")
    forget(keyed.sparkSession, written)
    return told


def find_pii(
    docs: DataFrame,
    support: int = MIN_SUPPORT,
    disclosure: float = DISCLOSURE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, row, base, terms of every row: spans of personal data and of disclosing terms.

    ``base`` are e-mail addresses, IP addresses, card and phone numbers, leftmost and
    non-overlapping per kind; ``terms`` are words that, over the whole corpus, share documents with one
    such value so exclusively that they disclose it (see ``disclosing_terms``). Offsets are code points,
    end exclusive. A null text is empty; rows that are equal in id and text get equal results and
    count as one document; a null doc_id is an id of its own. Other columns are not read. An empty
    table gives an empty result.
    """
    keyed = _keyed(docs, id_col, text_col)
    told = _told(keyed, support, disclosure)
    return _with_base(_with_terms(keyed, told)).select("doc_id", "row", "base", "terms")


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""
    told = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.concat("base", "terms")).alias("spans"),
    )


def sanitise(
    docs: DataFrame,
    support: int = MIN_SUPPORT,
    disclosure: float = DISCLOSURE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with personal data generalised to its kind and disclosing terms to ``[TERM]``.

    Spans are those of ``find_pii``. Overlapping spans become one, named after the first. Rows,
    columns and null texts stay.
    """
    keyed = _keyed(docs, id_col, text_col, F.struct(*docs.columns).alias("_doc"))
    narrow = keyed.drop("_doc")
    told = _told(narrow, support, disclosure)
    found = _with_base(_with_terms(keyed, told)).withColumn("_spans", F.concat("base", "terms"))
    clean = F.when(F.size("_spans") > 0, _replaced(F.col("text"), F.col("_spans"))).otherwise(F.col(f"_doc.{text_col}"))
    return found.select(*(clean.alias(c) if c == text_col else F.col(f"_doc.{c}").alias(c) for c in docs.columns))


def _replaced(text: Column, spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"])))

    def step(state: Column, s: Column) -> Column:
        end = -s["back"]
        apart = s["start"] >= state["at"]
        piece = F.concat(
            F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")
        )
        out = F.when(apart, F.array_append(state["out"], piece)).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], end).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(
        ordered,
        start,
        step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, s["at"] + 1, F.length(text))),
    )
