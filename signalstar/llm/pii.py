"""Personal data: patterns, and terms that reveal it by how they occur with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import body, stored

# Linear forms of the patterns: a match begins at the start of a run or where the last match
# ended, and nothing is given back that could not change the outcome.
PATTERNS: dict[str, str] = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = list(PATTERNS)
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

TERM = r"\p{L}+"  # words that may be terms
SUPPORT = 3  # documents in which a term and an entity must meet
DISCLOSURE = 0.9  # share of an entity's information that a term may reveal

SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,value:string>>"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-digit rule."""
    values = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        # A short run is settled before any digit is summed.
        return F.when(F.char_length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def with_spans(rows: DataFrame, text: str, kind: str, pattern: Column, kind_no: int) -> DataFrame:
    """Adds ``s_<kind>``: leftmost non-overlapping matches with their code point spans.

    A null text or pattern finds nothing. Positions are running sums of the lengths of the
    matches and of the pieces between them, summed by blocks of a square root of their
    number, so that a text with very many matches stays cheap.
    """
    zero, add = F.lit(0).cast("long"), lambda total, n: total + n
    matches, gaps, lengths, width, blocks = (f"{c}_{kind}" for c in "mglwb")
    some = F.size(matches) > 0
    rows = rows.withColumn(matches, F.regexp_extract_all(F.col(text), pattern, F.lit(0)))
    rows = rows.withColumn(gaps, F.when(some, F.transform(
        F.split(F.col(text), pattern, -1), lambda gap: F.char_length(gap).cast("long"))))
    rows = rows.withColumn(lengths, F.transform(
        matches, lambda m, i: F.char_length(m).cast("long") + F.get(F.col(gaps), i)))
    rows = rows.withColumn(
        width, F.ceil(F.sqrt(F.greatest(F.size(lengths), F.lit(1)))).cast("int"))
    rows = rows.withColumn(blocks, F.when(some, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / F.col(width)).cast("int")),
        lambda b: F.aggregate(F.slice(lengths, b * F.col(width) + 1, F.col(width)), zero, add))))

    def one(value: Column, i: Column) -> Column:
        block = F.floor(i / F.col(width)).cast("int")
        inside = i - block * F.col(width)
        start = (
            F.aggregate(F.slice(blocks, F.lit(1), block), zero, add)
            + F.aggregate(F.slice(lengths, block * F.col(width) + 1, inside), zero, add)
            + F.get(F.col(gaps), i)
        )
        return F.struct(
            start.alias("start"), F.lit(kind_no).alias("kind_no"),
            (start + F.char_length(value)).alias("end"), F.lit(kind).alias("kind"),
            value.alias("value"),
        )

    found = F.filter(F.transform(matches, one), lambda s: _valid(kind, s["value"])).cast(SPAN)
    rows = rows.withColumn(f"s_{kind}", F.when(some, found).otherwise(F.array().cast(SPAN)))
    return rows.drop(matches, gaps, lengths, width, blocks)


def _entity(span: Column) -> Column:
    """An entity by kind and bare value, however it is written."""
    value = F.when(
        span["kind"].isin("card", "phone"), F.regexp_replace(span["value"], "[^0-9]", "")
    ).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def found_entities(docs: DataFrame, id: str, text: str) -> DataFrame:
    """row (a number of its own), doc_id, base spans, and text and entities where there are any."""
    rows = docs.select(F.col(id).alias("doc_id"), body(text).alias("text"))
    # Where a needed character is missing the pattern is not tried.
    for kind, needed in NEEDED.items():
        may = F.col("text").contains(needed) & (F.lit(kind == "email") | F.col("text").rlike("[0-9]"))
        rows = rows.withColumn(f"t_{kind}", F.when(may, F.col("text")))
    for kind_no, kind in enumerate(KINDS):
        rows = with_spans(rows, f"t_{kind}", kind, F.lit(PATTERNS[kind]), kind_no)
    rows = rows.withColumn("spans", F.array_sort(F.concat(*[F.col(f"s_{k}") for k in KINDS])))
    some = F.size("spans") > 0
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "spans",
        F.when(some, F.col("text")).alias("text"),
        F.when(some, F.array_distinct(F.transform("spans", _entity))).alias("entities"),
    )


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def disclosing_terms(
    docs: DataFrame, found: DataFrame, text: str, support: int, disclosure: float
) -> DataFrame:
    """(row, term): words of a document that reveal too much of an entity it names.

    Over whole documents, PMI(term; entity) = ln(N n_et / (n_e n_t)) is what a term tells of
    an entity and ln(N / n_e) is all there is to tell; a pair discloses if the first reaches
    ``disclosure`` of the second and n_et ``support``. As n_et is at most n_e, a term can do
    so only if ln(N / n_t) reaches that share by itself: frequent words leave before they
    are paired, and only entities with ``support`` are paired at all.
    """
    n = float(found.count())
    named = found.select("row", F.explode("entities").alias("entity"))
    n_entity = named.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") >= support)
    most = n_entity.agg(F.max("n_e")).first()[0] or support

    def may(n_e: Column) -> Column:
        return F.log(F.lit(n) / F.col("n_t")) >= disclosure * F.log(F.lit(n) / n_e) - 1e-9

    named = named.join(n_entity, "entity")
    n_term = docs.select(F.explode(_words(body(text))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_t")
    ).where((F.col("n_t") >= support) & may(F.lit(most)))
    held = found.join(named.select("row").distinct(), "row", "left_semi").select(
        "row", F.explode(_words(F.col("text"))).alias("term")
    ).join(n_term, "term")
    pairs = stored(
        named.join(held, "row").where(may(F.col("n_e"))).select("row", "entity", "term", "n_e", "n_t"),
        "pii-pairs",
    )
    tells = F.log(F.lit(n) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    all_ = F.log(F.lit(n) / F.col("n_e"))
    flagged = (
        pairs.groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_et"), F.min("n_e").alias("n_e"), F.min("n_t").alias("n_t"))
        .where((F.col("n_et") >= support) & (all_ > 0) & (tells >= disclosure * all_))
        .select("entity", "term")
    )
    return pairs.join(flagged, ["entity", "term"]).select("row", "term").distinct()


def personal_data(
    docs: DataFrame, id: str = "doc_id", text: str = "text", support: int = SUPPORT,
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term,
    clean_text.

    Base spans are the patterns' leftmost non-overlapping matches per kind that pass their
    checks. Added spans are of kind ``term``: in a document that names an entity, each whole
    word, of any length and at any distance, that reveals the entity beyond the threshold over
    the corpus, wherever it stands outside base spans. A word inside an entity is a word too:
    the name out of an address goes where it stands alone. ``clean_text`` has base spans replaced by their kind and terms by a
    blank placeholder; it is null where there is nothing to replace. Null texts are empty;
    rows with equal id and text get equal results; other columns are not read. All in SQL
    expressions: the only shuffles carry counts, words, pairs and the texts with entities.
    """
    found = stored(found_entities(docs, id, text), "pii-found")
    terms = (
        disclosing_terms(docs, found, text, support, disclosure)
        .groupBy("row").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    )
    rows = found.drop("entities").join(terms, "row", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    rows = with_spans(rows.withColumn("pattern", pattern), "text", "term", F.col("pattern"), len(KINDS))
    rows = rows.withColumn("s_term", F.filter(F.coalesce("s_term", F.array().cast(SPAN)), lambda t: ~F.exists(
        "spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
    rows = rows.withColumn("all_spans", F.array_sort(F.concat("spans", "s_term")))

    def digest(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(digest("spans").cast("binary"), 256).alias("base_sha256"),
        digest("all_spans").alias("spans"),
        F.size("s_term").cast("long").alias("n_term"),
        _cleaned().alias("clean_text"),
    )


def _cleaned() -> Column:
    """The text with spans replaced; of overlapping ones the first stands for all it meets."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.col("text").substr((done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        label = F.when(s["kind"] == "term", F.lit("[...]")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        return F.when(
            s["start"] >= done["at"],
            F.struct(s["end"].alias("at"), F.concat(done["out"], gap, label).alias("out")),
        ).otherwise(F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out")))

    rest = F.aggregate("all_spans", start, step, lambda done: F.concat(
        done["out"], F.col("text").substr((done["at"] + 1).cast("int"), F.char_length("text"))))
    return F.when(F.size("all_spans") > 0, rest)
