"""Personal data and the terms that give it away.

Base kinds are found by pattern. Information-theoretic sanitisation adds to them: the corpus tells how
strongly a term in an identifier's documents reveals it. With p estimated from document counts, a term t discloses
an identifier e by PMI(t; e) / IC(e) = log(p(e|t) / p(e)) / -log p(e), which is 0 for unrelated terms and
1 for a term that occurs only with e. Terms beyond one threshold are generalised, beyond a higher one
removed, at all their places in all documents. Whole documents count, however far a term is from the
identifier; terms too frequent to reach the threshold are left out before they are paired.

Only DataFrame functions are used. Patterns are written so that no text takes more than linear time:
possessive runs, and a look-behind that starts a match only where a run starts (or the last match ended),
which finds the same leftmost matches as the plain patterns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import broadcast_checked
from .common import materialize, row_key, text_or_empty

# Kinds of personal data in the order in which they are listed, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a kind to occur at all; cheaper than the pattern.
HINTS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){13}[0-9]",
    "phone": r"\+[0-9]",
}
REMOVED, GENERALISED = "removed", "generalised"
ORDER = {k: i for i, k in enumerate([*KINDS, REMOVED, GENERALISED])}

# A run of letters, whatever stands around it.
TERM = r"(?<![\p{L}\p{M}])\p{L}[\p{L}\p{M}]++"


@dataclass(frozen=True)
class Disclosure:
    """Settings of the disclosure estimate.

    `support` is how many different texts must hold a term and an identifier before the estimate counts.
    """

    support: int = 3
    generalise: float = 0.85
    remove: float = 0.95


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    from_right = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.when((F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1))).otherwise(
            # Double of a digit with the digits of the double added up.
            F.translate(F.substring(digits, i, F.lit(1)), "0123456789", "0246813579")).cast("int"),
    )
    return F.aggregate(from_right, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).when(F.length(p) == 0, True).otherwise(
        p.cast("int") <= 255))
    card = F.length(digits).between(14, 19)
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", F.when(card, _luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(10, 15))
        .otherwise(True)
    )


def base_spans(keyed: DataFrame) -> DataFrame:
    """One row per base span of the rows (key_id, key_text, text).

    Places come from the lengths of the matches and of the stretches between them, summed up per text and
    kind, so no text is searched twice.
    """
    hits = {
        k: F.when(F.col("text").rlike(HINTS[k]), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)))
        for k in KINDS
    }
    found = keyed.select("key_id", "key_text", "text", *[c.alias(k) for k, c in hits.items()])
    per_kind = F.filter(
        F.array(*[F.struct(
            F.lit(k).alias("kind"), F.col(k).alias("hits"),
            F.when(F.size(k) > 0, F.split("text", PATTERNS[k], -1)).alias("gaps"),
        ) for k in KINDS]),
        lambda x: F.size(x["hits"]) > 0,
    )
    rows = found.select("key_id", "key_text", F.explode(per_kind).alias("x")).select("key_id", "key_text", "x.*")
    rows = rows.select(
        "key_id", "key_text", "kind",
        F.posexplode(F.arrays_zip("hits", "gaps")).alias("at", "z"),
    ).where("z.hits IS NOT NULL").select(
        "key_id", "key_text", "kind", "at", F.col("z.hits").alias("value"),
        F.length("z.gaps").cast("long").alias("gap"),
    ).dropDuplicates(["key_id", "key_text", "kind", "at"])
    upto = Window.partitionBy("key_id", "key_text", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return placed.where(_valid(F.col("kind"), F.col("value"))).select(
        "key_id", "key_text", "kind", "start", "end", "value")


def _without_addresses(text: str) -> Column:
    """The text with blanks for the only base kind that holds letters; all places stay."""
    pattern = F.lit(PATTERNS["email"])
    pieces = F.zip_with(
        F.split(text, PATTERNS["email"], -1), F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda gap, hit: F.concat(gap, F.coalesce(F.repeat(F.lit(" "), F.length(hit)), F.lit(""))))
    return F.when(F.col(text).rlike(HINTS["email"]), F.array_join(pieces, "")).otherwise(F.col(text))


def _terms_of(text: str) -> Column:
    """The distinct lower-cased terms of a text."""
    hits = F.regexp_extract_all(_without_addresses(text), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(hits, F.lower))


def disclosing_terms(keyed: DataFrame, spans: DataFrame, settings: Disclosure) -> DataFrame:
    """(entity, term, action) of the terms that reveal an identifier beyond a threshold.

    All counts are rows of the whole corpus; `support` counts different texts, so that copies of one
    text do not make an estimate trustworthy. As n_te is at most n_e, a term can reach a ratio r only if
    n_t <= n_all ** (1 - r) * n_e ** r, so more frequent terms are not paired with the identifier.
    """
    document = ["key_id", "key_text"]
    least = min(settings.generalise, settings.remove)
    n_all = keyed.count()
    entities = spans.select(*document, F.concat_ws(":", "kind", F.lower("value")).alias("entity")).distinct()
    held = keyed.select(*document).join(entities, document)
    n_entity = held.groupBy("entity", "key_text").agg(F.count(F.lit(1)).alias("n")).groupBy("entity").agg(
        F.sum("n").alias("n_e"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= settings.support)
    # Rounded up, as the exact ratio decides in the end.
    reach = F.pow(F.lit(float(n_all)), F.lit(1 - least)) * F.pow(F.col("n_e").cast("double"), F.lit(least)) * (1 + 1e-9)
    rateable = materialize(
        n_entity.select("entity", "n_e", F.when(F.lit(least > 0), reach).otherwise(F.lit(float("inf"))).alias("reach")), "entities")
    most = rateable.agg(F.max("reach")).first()[0]
    everywhere = keyed.select(F.explode(_terms_of("text")).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_t")).where(F.col("n_t").between(settings.support, F.lit(0.0 if most is None else most)))
    everywhere = materialize(everywhere, "everywhere")
    # Documents with an identifier that can be rated, and their terms that are rare enough for one.
    of = materialize(entities.join(rateable, "entity"), "of")
    texts = keyed.join(of.select(*document).distinct(), document, "left_semi")
    terms = texts.select(*document, F.explode(_terms_of("text")).alias("term")).join(everywhere, "term")
    together = terms.join(of, document).where("n_t <= reach").groupBy(
        "entity", "term", "key_text", "n_t", "n_e").agg(F.count(F.lit(1)).alias("n")).groupBy(
        "entity", "term", "n_t", "n_e").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("texts"))
    rated = together.where(F.col("texts") >= settings.support).withColumn("n_all", F.lit(n_all))
    gain = F.log(F.col("n_te") * F.col("n_all") / (F.col("n_t").cast("double") * F.col("n_e")))
    content = F.log(F.col("n_all") / F.col("n_e").cast("double"))
    rated = rated.withColumn("ratio", F.when(content > 0, gain / content).otherwise(0.0))
    action = F.when(F.col("ratio") >= settings.remove, REMOVED).when(F.col("ratio") >= settings.generalise, GENERALISED)
    return rated.select("entity", "term", action.alias("action"), "ratio").where("action IS NOT NULL")


def term_spans(keyed: DataFrame, marked: DataFrame) -> DataFrame:
    """(key_id, key_text, kind, start, end) of all places of the terms of `marked` (term, strong)."""
    document = ["key_id", "key_text"]
    marked = broadcast_checked(marked)
    found = keyed.select(*document, F.explode(_terms_of("text")).alias("term")).join(marked, "term")
    holders = found.select(*document).distinct()
    blank = keyed.join(holders, document, "left_semi").dropDuplicates(document).select(
        *document, _without_addresses("text").alias("text")).select(
        *document, F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("hits"), F.split("text", TERM, -1).alias("gaps"))
    lengths = F.zip_with("hits", F.expr("slice(gaps, 1, size(hits))"), lambda hit, gap: F.struct(
        F.lower(hit).alias("term"), F.length(hit).alias("size"), F.length(gap).alias("gap")))
    rows = blank.select(*document, F.posexplode(lengths).alias("at", "z")).select(*document, "at", "z.*")
    upto = Window.partitionBy(*document).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto))
    named = F.when(F.col("strong"), REMOVED).otherwise(GENERALISED)
    return placed.join(marked, "term").select(
        *document, named.alias("kind"), (F.col("end") - F.col("size")).alias("start"), "end")


def find_spans(docs: DataFrame, settings: Disclosure = Disclosure(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All spans (key_id, key_text, kind, start, end): base kinds and disclosing terms.

    A null text is empty. Rows that repeat an id and text have one set of spans; a missing id is the
    smallest long. An empty table has none. A document's spans are one task's work, nothing larger is.
    """
    keyed = docs.select(*row_key(id_column, text_column), text_or_empty(text_column).alias("text"))
    spans = materialize(base_spans(keyed), "spans")
    # A term that reveals several identifiers takes the stronger action.
    marked = materialize(disclosing_terms(keyed, spans, settings).groupBy("term").agg(
        F.max(F.col("action") == REMOVED).alias("strong")), "marked")
    columns = ["key_id", "key_text", "kind", "start", "end"]
    return materialize(spans.select(*columns).union(term_spans(keyed, marked).select(*columns)), "found")


def kind_order(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, i in ORDER.items() for x in (k, i)]), kind)


def report(docs: DataFrame, settings: Disclosure = Disclosure(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, counts of the base kinds, digest of the base spans, and all spans as text.

    See `find_spans` for nulls, repeated rows and empty tables. Other columns are not read.
    """
    found = find_spans(docs, settings, id_column, text_column)
    shown = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    base = F.col("kind").isin(KINDS)

    def listed(rows: Column) -> Column:
        return F.concat_ws(",", F.transform(F.sort_array(rows), lambda x: x["shown"]))

    item = F.struct("start", kind_order(F.col("kind")).alias("rank"), shown.alias("shown"))
    per_document = found.groupBy("key_id", "key_text").agg(
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in KINDS],
        listed(F.collect_list(F.when(base, item))).alias("base"), listed(F.collect_list(item)).alias("spans"),
    )
    rows = docs.select(F.col(id_column).alias("doc_id"), *row_key(id_column, text_column))
    return rows.join(per_document, ["key_id", "key_text"], "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def sanitised(docs: DataFrame, settings: Disclosure = Disclosure(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with its spans replaced in the text, all other columns unchanged.

    Base kinds become their names in brackets, generalised terms "[term]", removed terms nothing.
    Where spans overlap, the first one's replacement stands for all. A text without spans, null included,
    stays as it is.
    """
    found = find_spans(docs, settings, id_column, text_column)
    tag = F.when(F.col("kind") == REMOVED, "").when(F.col("kind") == GENERALISED, "[term]").otherwise(
        F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
    cuts = found.groupBy("key_id", "key_text").agg(F.sort_array(F.collect_list(F.struct(
        F.col("start").cast("int").alias("start"), kind_order(F.col("kind")).alias("rank"),
        F.col("end").cast("int").alias("end"), tag.alias("tag")))).alias("cuts"))
    taken = docs.columns
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in taken]).alias("row"), *row_key(id_column, text_column),
        docs[f"`{text_column}`"].alias("text"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, x: Column) -> Column:
        kept = F.substring(F.col("text"), state["at"] + 1, x["start"] - state["at"])
        fresh = x["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(state["done"], kept, x["tag"])).otherwise(state["done"]).alias("done"),
        )

    clean = F.aggregate("cuts", start, step, lambda s: F.concat(
        s["done"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    joined = keyed.join(cuts, ["key_id", "key_text"], "left").withColumn(
        "text", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(clean))
    return joined.select(*[(F.col("text") if c == text_column else F.col("row")[c]).alias(c) for c in taken])
