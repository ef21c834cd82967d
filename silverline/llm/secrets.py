"""Secret scans over a trigram inverted index, in DataFrame functions only.

Every rule's expression gives a Boolean trigram query. The index holds a posting (trigram, document)
for each trigram that some query names; postings are intersected per alternative of a rule, and only
the documents that remain are verified by the expression. Rules without mandatory trigrams scan
every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm import trigrams

# Matches whose places are summed in one array; longer lists are summed in two levels.
_STRETCH = 512


@dataclass(frozen=True)
class Rule:
    """An expression, the group whose length counts, and its least length."""

    kind: str
    expression: str
    group: int = 0
    least: int = 1


# The three base kinds in the order of the listing. A maximal run of hex digits is one
# match, so short runs need not be matched to be dropped.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}=*"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]{1,64}:[^\x20\x09-\x0D/@]{3,128}@"),
)
RULES = BASE_RULES + MORE_RULES

_KEY = "_document"


def _key() -> Column:
    # Documents that share a key by chance are verified needlessly, never wrongly.
    return F.xxhash64("doc_id", "text")


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(trigram, document key) for every trigram that a rule's query names and a text holds, in lower case."""
    named = sorted({gram for rule in rules for way in trigrams.query(rule.expression) for gram in way})
    grams = F.array(*[F.lit(g) for g in named]) if named else F.expr("cast(array() as array<string>)")
    # The lambda's variable holds the lower-cased text, so it is made once per row.
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(grams, lambda g: F.contains(low, g)))[0]
    return docs.filter("text is not null").select(_key().alias(_KEY), F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(document key, numbers of the rules whose trigram query it satisfies), by intersecting postings."""
    terms = [
        (number, alternative, gram, len(way))
        for number, rule in enumerate(rules)
        for alternative, way in enumerate(trigrams.query(rule.expression))
        for gram in sorted(way)
    ]
    # A few hundred rows at most, however many texts: the rules alone decide.
    wanted = F.broadcast(index.sparkSession.createDataFrame(terms, "rule int, alternative int, trigram string, terms int"))
    met = (
        index.join(wanted, "trigram")
        .groupBy(_KEY, "rule", "alternative", "terms")
        .agg(F.count_distinct("trigram").alias("met"))
        .filter("met = terms")
    )
    return met.groupBy(_KEY).agg(F.collect_set("rule").alias("rules"))


def _spans(rule: Rule, number: int) -> Column:
    """Spans of a rule in `text`: leftmost matches that are long enough, with code point places.

    Matches and the gaps between them come from the same expression; lengths of both, summed, are places.
    """
    pattern = F.lit(rule.expression)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    sizes = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else matches
    gaps = F.split("text", rule.expression, -1)
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), sizes.alias("size"))
    steps = F.transform(
        parts,
        lambda p: F.struct(
            F.length(p["gap"]).cast("long").alias("gap"), F.length(p["match"]).cast("long").alias("size"), (F.length(p["size"]) >= rule.least).alias("good")
        ),
    )

    def placed(all_steps: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_steps), F.lit(_STRETCH))
        totals = F.transform(
            starts, lambda s: F.aggregate(F.slice(all_steps, s, _STRETCH), F.lit(0).cast("long"), lambda a, x: a + x["gap"] + x["size"])
        )
        empty = F.expr("cast(array() as array<bigint>)")
        bases = F.aggregate(
            totals,
            F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        )["out"]
        none = F.expr("cast(array() as array<struct<start:bigint, kind:int, end:bigint, good:boolean>>)")

        def stretch(start: Column, base: Column) -> Column:
            return F.aggregate(
                F.slice(all_steps, start, _STRETCH),
                F.struct(base.alias("at"), none.alias("out")),
                lambda a, x: F.struct(
                    (a["at"] + x["gap"] + x["size"]).alias("at"),
                    F.concat(
                        a["out"],
                        F.array(
                            F.struct(
                                (a["at"] + x["gap"]).alias("start"),
                                F.lit(number).alias("kind"),
                                (a["at"] + x["gap"] + x["size"]).alias("end"),
                                x["good"].alias("good"),
                            )
                        ),
                    ).alias("out"),
                ),
            )["out"]

        return F.flatten(F.zip_with(starts, bases, stretch))

    # Lambda variables again, so that the expression runs once for each use of its matches.
    found = F.transform(F.array(steps), lambda s: F.when(F.size(s) > 0, F.filter(placed(s), lambda x: x["good"])))[0]
    return F.when(F.regexp_like("text", pattern), found)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) with spans (start, kind number, end) of every document, by start, then kind.

    The index is read in the same job as the texts are; texts move once, to meet their candidates,
    unless these are few enough for Spark to send them round instead. NULL text counts as empty and
    has no spans; a NULL id stays NULL; repeated rows each get their spans; an empty table gives no
    rows; columns other than doc_id and text are not looked at.
    """
    docs = docs.select("doc_id", "text")
    met = candidates(postings(docs, rules), rules)
    # A document's copies share a key: each finds the one row of candidates.
    joined = docs.withColumn(_KEY, _key()).join(met, _KEY, "left")
    none = F.expr("cast(array() as array<struct<start:bigint, kind:int, end:bigint>>)")
    lists = []
    for number, rule in enumerate(rules):
        spans = F.transform(_spans(rule, number), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
        if trigrams.query(rule.expression):
            spans = F.when(F.array_contains("rules", number), spans)
        lists.append(F.coalesce(spans, none))
    return joined.select("doc_id", F.array_sort(F.concat(*lists)).alias("spans"))
