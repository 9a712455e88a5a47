"""Personal data: rule-based spans, and candidates judged by gradient-boosted trees.

Base spans of four kinds follow fixed patterns and checks and always stay. High-recall
generators propose further spans: every run of neighbouring groups of digits that has 7
to 19 of them, and addresses with a written-out "at" or "dot"; their spans overlap the
base ones and each other. Boosted trees over the format and the context of a span select
those to add, by thresholds calibrated per kind on spans kept out of the training. An
added span never meets a base span.

Everything on the main path is built-in functions over one row, without a shuffle or
Python: the trees are stored as nested CASE expressions. Positions count code points,
ends are exclusive.

Null and empty texts have no spans. Repeated rows are searched each. Without both kinds
of training spans nothing is added to the base. An empty table gives an empty result.
Columns of the input are kept; those made here begin with two underscores.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, GBTClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.tables import written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.99
LEAST_THRESHOLD = 0.5

# Fixed patterns of the base kinds, with possessive quantifiers: the classes around each
# are disjoint, so matches are those of the plain forms, without backtracking. A match
# starts at the head of its run or where the last one ended.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    # Runs of fewer than 13 digits fail the check in any case.
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold before its pattern is tried.
_HINT = {"email": "@", "phone": "+"}

_AT = r"(?:@|\x20?[\[(]\x20?at\x20?[\])]\x20?)"
_DOT = r"(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)"
_ADDRESS = rf"[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+"
GENERATORS = {
    # Whole runs; _groups() makes the spans of them.
    "number": r"(?<![0-9A-Za-z])[+]?+[(]?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "address": rf"(?<![{_LOCAL}]){_ADDRESS}",
    # What the host of another address begins.
    "chained": rf"(?<={_AT}){_ADDRESS}",
}
_GROUP = r"[+]?+[(]?+[0-9]++"

_SPAN = "struct<kind:string,start:int,end:int,text:string>"
_PLACE = "struct<kind:string,start:int,end:int>"

# Figures of a span c in the text, with what stands around it: format, then context.
FEATURES = (
    "CAST(length(c.text) AS DOUBLE)",
    "CAST(length(regexp_replace(c.text, '[^0-9]', '')) AS DOUBLE)",
    "CAST(length(regexp_replace(c.text, '[^A-Za-z]', '')) AS DOUBLE)",
    "IF(c.text RLIKE '[A-Za-z]', 0D, CAST(length(regexp_replace(c.text, '[^.]', '')) AS DOUBLE))",
    "CAST(length(regexp_replace(c.text, '[^ ()-]', '')) AS DOUBLE)",
    "IF(startswith(c.text, '+'), 1D, 0D)",
    "IF(contains(c.text, '@'), 1D, 0D)",
    "IF(c.text RLIKE '@.*[.][a-z]{2,}$', 1D, 0D)",
    "IF({luhn}, 1D, 0D)",
    "IF(c.text RLIKE '(^|[.])0*([3-9][0-9]{2}|2[6-9][0-9]|25[6-9]|[0-9]{4,})([.]|$)', 1D, 0D)",
    "IF(c.before RLIKE '(?i)(mail|contact|write|tel|phone|call|fon|mobil|fax|card|visa|ip|host)',"
    " 1D, 0D)",
    # A number right before, with nothing but separators between, says nothing.
    "CAST(length(regexp_replace(regexp_replace(c.before, '[+(]*[0-9][0-9 ().+-]*$', ''), "
    "'[^0-9]', '')) AS DOUBLE)",
    "CAST(length(regexp_replace(c.before, '[^$%#|=<>{}]', '')) AS DOUBLE)",
    "IF(c.after RLIKE '^[ .,;:!?)]*( |\\n|$)', 1D, 0D)",
    "IF({form}, 1D, 0D)",
    "IF({date}, 1D, 0D)",
)


def _luhn(digits: str) -> str:
    """Whether a text of digits passes the Luhn check."""
    doubled = "CAST(substr(reverse(d), i, 1) AS INT) * IF(i % 2 = 0, 2, 1)"
    return (
        f"exists(array({digits}), d -> length(d) > 0 AND aggregate(sequence(1, length(d)), 0, "
        f"(sum, i) -> sum + ({doubled}) - IF({doubled} > 9, 9, 0)) % 10 = 0)"
    )


_DIGITS = "regexp_replace(c.text, '[^0-9]', '')"
CHECKS = {
    "email": "true",
    "ip": "forall(split(c.text, '[.]'), p -> length(regexp_replace(p, '^0+', '')) <= 3 AND "
          "coalesce(try_cast(p AS INT), 0) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_luhn(_DIGITS)}",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}

_DATE = ("c.text RLIKE '(^|[^0-9])((19|20)[0-9]{2}[ .-][0-9]{1,2}[ .-][0-9]{1,2}|"
         "[0-9]{1,2}[ .-][0-9]{1,2}[ .-](19|20)[0-9]{2})([^0-9]|$)'")
# The usual notations of each kind: base spans and their variants.
FORMS = {
    "email": rf"c.text RLIKE r'^[{_LOCAL}]+@([A-Za-z0-9-]+[.])+[A-Za-z]{{2,}}$'",
    "ip": f"c.text RLIKE '^[0-9]+([.][0-9]+){{3}}$' AND {CHECKS['ip']}",
    "card": f"c.text RLIKE '^[0-9]([ -]?[0-9])+$' AND {CHECKS['card']}",
    # With a plus, in groups after a 0, or three, three and four digits after any code.
    "phone": f"{CHECKS['phone']} AND NOT {_DATE} AND (startswith(c.text, '+') OR c.text RLIKE "
             "'^[(]?0[0-9]*[ ().-]+[0-9]{2}|^([0-9]{1,3}[ .-])?[(]?[0-9]{3}[)]?[ .-]?[ ]?"
             "[0-9]{3}[ .-][0-9]{4}$')",
}


def _by_kind(conditions: dict[str, str]) -> str:
    return "CASE c.kind " + " ".join(f"WHEN '{k}' THEN {c}" for k, c in conditions.items()) + " END"


@dataclass
class SpanModel:
    """The boosted trees as SQL over an array f, and a threshold for each kind."""

    score: str | None = None
    thresholds: dict[str, float] = field(default_factory=dict)


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _matched(name: str, pattern: str) -> Column:
    hint = F.col("__text").contains(_HINT[name]) if name in _HINT else (
        F.col("__text").rlike(r"@|[\[(]\x20?at\x20?[\])]") if name in ("address", "chained")
        else F.col("__text").rlike("[0-9]"))
    return F.when(hint, F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _spans(name: str, pattern: str) -> Column:
    """Spans of the matches: what lies between them, cut at the same pattern, and they
    themselves add up to their positions."""
    start = "acc.at + length(p.between)"
    end = f"{start} + length(p.hit)"
    return F.expr(
        f"CASE WHEN size(__{name}) = 0 THEN CAST(array() AS array<{_SPAN}>) ELSE aggregate("
        f"zip_with(slice(split(__text, {_literal(pattern)}, -1), 1, size(__{name})), __{name}, "
        "(b, h) -> named_struct('between', b, 'hit', h)), "
        f"named_struct('at', 0, 'spans', CAST(array() AS array<{_SPAN}>)), "
        f"(acc, p) -> named_struct('at', {end}, 'spans', array_append(acc.spans, "
        f"named_struct('kind', '{name}', 'start', {start}, 'end', {end}, 'text', p.hit))), "
        "acc -> acc.spans) END")


def _groups() -> Column:
    """Spans of 7 to 19 digits in all of a run's neighbouring groups; no kind has more.

    A last group that runs on into a word is none.
    """
    end = "acc.at + length(p.between) + length(p.hit)"
    upto = "acc.digits + length(regexp_replace(p.hit, '[^0-9]', ''))"
    group = "struct<start:int,end:int,before:int,upto:int>"
    groups = (
        f"aggregate(zip_with(slice(split(r.text, {_literal(_GROUP)}, -1), 1, "
        f"size(regexp_extract_all(r.text, {_literal(_GROUP)}, 0))), "
        f"regexp_extract_all(r.text, {_literal(_GROUP)}, 0), "
        "(b, h) -> named_struct('between', b, 'hit', h)), "
        f"named_struct('at', 0, 'digits', 0, 'groups', CAST(array() AS array<{group}>)), "
        f"(acc, p) -> named_struct('at', {end}, 'digits', {upto}, 'groups', array_append("
        f"acc.groups, named_struct('start', acc.at + length(p.between), 'end', {end}, "
        f"'before', acc.digits, 'upto', {upto}))), "
        "acc -> IF(substr(__text, r.end + 1, 1) RLIKE '[0-9A-Za-z]', "
        "slice(acc.groups, 1, size(acc.groups) - 1), acc.groups))")
    # More than 19 groups have more than 19 digits.
    return F.expr(
        f"flatten(transform(__at_number, r -> flatten(transform(array({groups}), g -> "
        "flatten(transform(g, (first, i) -> transform(filter(slice(g, i + 1, 19), last -> "
        "last.upto - first.before BETWEEN 7 AND 19), last -> named_struct('kind', 'number', "
        "'start', r.start + first.start, 'end', r.start + last.end, 'text', "
        "substr(r.text, first.start + 1, last.end - first.start)))))))))")


def base_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``__text``, ``__base`` (by kind, then start) and ``__wide``."""
    kept = documents.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    patterns = {**BASE, **GENERATORS}
    kept = kept.withColumns({f"__{n}": _matched(n, p) for n, p in patterns.items()})
    kept = kept.withColumns({f"__at_{n}": _spans(n, p) for n, p in patterns.items()})
    base = [F.expr(f"filter(__at_{kind}, c -> {CHECKS[kind]})") for kind in KINDS]
    kept = kept.withColumns({
        "__base": F.concat(*base),
        "__wide": F.concat(_groups(), F.col("__at_address"), F.col("__at_chained")),
    })
    return kept.drop(*(f"__{n}" for n in patterns), *(f"__at_{n}" for n in patterns))


_HOST = "substring_index(c.text, '@', -1)"
_NATIONAL = "regexp_replace(c.text, '^[+][0-9]+[ .-]*', '')"
# Other notations of a base span, which are as good, where they keep to the forms.
VARIED = {
    "email": ("regexp_replace(c.text, '@.*?([A-Za-z-]+[.][A-Za-z]+)$', '@$1')",
              "regexp_replace(regexp_replace(c.text, '[0-9]', ''), "
              "'^.*?([A-Za-z-]+@).*?([A-Za-z-]+[.][A-Za-z]+)$', '$1$2')"),
    "phone": ("ltrim('+', c.text)", _NATIONAL,
              f"ltrim('-', regexp_replace({_NATIONAL}, '[^0-9]+', '-'))"),
}
# What a base span of each kind is turned into to serve as an example of none: forms that
# no kind has.
SPOILED = {
    "email": (f"concat(substring_index(c.text, '@', 1), '@', substring_index({_HOST}, '.', 1))",
              f"concat(substring_index(c.text, '@', 1), '@', replace({_HOST}, '.', '-'))"),
    "ip": ("regexp_replace(c.text, '^[0-9]+', '999')", "regexp_replace(c.text, '[.][0-9]+$', '')"),
    "card": ("concat(left(c.text, length(c.text) - 1), "
             "CAST((CAST(right(c.text, 1) AS INT) + 1) % 10 AS STRING))", "left(c.text, 9)"),
    "phone": ("left(c.text, 10)", f"left({_DIGITS}, 8)",
              f"concat('20', substr({_DIGITS}, 2, 2), '-0', right(c.text, 1), '-1', "
              f"substr({_DIGITS}, 5, 1), ' 1', substr({_DIGITS}, 6, 1))"),
}
# What is no example of none: it passes the check of its kind, so it may well be one.
_LIKELY = _by_kind(CHECKS | {"phone": f"{CHECKS['phone']} AND NOT {_DATE}"})


def _made(texts: dict[str, tuple[str, ...]], label: str) -> list[str]:
    return [
        f"transform(filter(__placed, c -> c.label AND c.kind = '{kind}'), c -> named_struct("
        f"'kind', c.kind, 'start', c.start, 'end', c.end, 'text', {text}, 'before', c.before, "
        f"'after', c.after, 'label', {label}))"
        for kind, some in texts.items() for text in some
    ]


def candidates(spans: DataFrame, training: bool = False) -> DataFrame:
    """Adds ``__candidates``: kind and features of the generators' spans that meet no base
    span; with ``training`` labelled examples instead.

    Examples of personal data are the base spans among the generators' spans and other
    notations of these, examples of none are base spans spoiled and spans that meet no base
    span and fail the check of their kind.
    """
    kind = ("CASE WHEN c.kind = 'number' THEN CASE "
            "WHEN c.text RLIKE '^[0-9]+([.][0-9]+){3}$' THEN 'ip' "
            f"WHEN length({_DIGITS}) BETWEEN 13 AND 19 AND NOT c.text RLIKE '^([+]|00)' "
            "THEN 'card' ELSE 'phone' END ELSE 'email' END")
    # Written-out signs are judged like the signs.
    plain = (f"regexp_replace(regexp_replace(c.text, {_literal(_AT)}, '@'), "
             f"{_literal(_DOT)}, '.')")
    meets = "exists(__base, b -> b.start < c.end AND c.start < b.end)"
    base = "exists(__base, b -> b.start = c.start AND b.end = c.end)"
    spans = spans.withColumn("__near", F.expr(
        f"filter(__wide, c -> NOT {meets}" + f" OR {base})" * training + ")" * (not training)))
    spans = spans.withColumn("__placed", F.expr(
        f"transform(__near, c -> named_struct('kind', {kind}, 'start', c.start, 'end', c.end, "
        f"'text', {plain}, 'before', substr(__text, greatest(c.start - 24, 0) + 1, "
        f"least(24, c.start)), 'after', substr(__text, c.end + 1, 8), 'label', {meets}))"))
    form = _by_kind(FORMS)
    if training:
        none = f"filter(__placed, c -> NOT c.label AND NOT {_LIKELY})"
        kept = f"filter(__placed, c -> c.label), {none}"
        varied = f"filter(concat({', '.join(_made(VARIED, 'true'))}), c -> {form})"
        spans = spans.withColumn("__placed", F.expr(
            f"concat({kept}, {varied}, {', '.join(_made(SPOILED, 'false'))})"))
    features = ", ".join(
        f.replace("{luhn}", _luhn(_DIGITS)).replace("{form}", form).replace("{date}", _DATE)
        for f in FEATURES)
    return spans.withColumn("__candidates", F.expr(
        "transform(__placed, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, "
        f"'label', c.label, 'f', array({features})))")).drop("__near", "__placed")


def _tree_sql(node) -> str:
    """A tree's nodes as nested CASE expressions."""
    if node.subtreeDepth() == 0:
        return f"{node.prediction()!r}D"
    split = node.split()
    return (f"CASE WHEN c.f[{split.featureIndex()}] <= {split.threshold()!r}D "
            f"THEN {_tree_sql(node.leftChild())} ELSE {_tree_sql(node.rightChild())} END")


def _model_sql(model: GBTClassificationModel) -> str:
    trees = [tree._call_java("rootNode") for tree in model.trees]
    margin = " + ".join(f"{weight!r}D * {_tree_sql(root)}"
                        for weight, root in zip(model.treeWeights, trees, strict=True))
    return f"1D / (1D + exp(-2D * ({margin})))"


def fit(documents: DataFrame, text: str = "text", key: str = "doc_id",
        precision: float = PRECISION) -> SpanModel:
    """Trees and thresholds from the candidates of all documents.

    Every fourth document by the hash of its key serves to calibrate. Equal examples are one
    row with their number as its weight, which trains the same trees.
    """
    # Stored, so that the texts are searched once, whatever is pulled out of the examples.
    spans = written(base_spans(documents.select(key, text), text).where("size(__wide) > 0")
                    .select(key, "__text", "__base", "__wide"), "pii-spans")
    rows = written(
        candidates(spans, training=True)
        .select(F.pmod(F.xxhash64(key), F.lit(4)).alias("fold"), F.explode("__candidates").alias("c"))
        .select((F.col("fold") == 0).alias("held"), "c.kind", "c.f",
                F.col("c.label").cast("double").alias("label"))
        .groupBy("held", "kind", "f", "label").agg(F.count("*").alias("n")),
        "pii-candidates")
    training, held = rows.where("NOT held"), rows.where("held")
    if len(training.select("label").distinct().collect()) < 2:
        return SpanModel()
    examples = training.groupBy("f", "label").agg(F.sum("n").cast("double").alias("weight"))
    # Spark draws rows to find where to split unless there are no more than bins squared.
    bins = max(32, math.isqrt(training.count()) + 1)
    model = GBTClassifier(maxIter=8, maxDepth=3, seed=7, stepSize=0.3, maxBins=bins,
                          weightCol="weight").fit(
        examples.select("label", "weight", array_to_vector("f").alias("features")))
    score = _model_sql(model)
    counted = (
        held.select("kind", "label", "n",
                    F.expr(f"floor(100 * element_at(transform(array(named_struct('f', f)), "
                           f"c -> {score}), 1))").cast("int").alias("step"))
        .groupBy("kind", "step").agg(
            F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("right"))
        .collect()
    )
    thresholds = {}
    for kind in KINDS:
        steps = {row.step: (row.n, row.right) for row in counted if row.kind == kind}
        n = right = 0
        lowest = None
        for step in sorted(steps, reverse=True):
            n, right = n + steps[step][0], right + steps[step][1]
            if right >= precision * n:
                lowest = step
        if lowest is not None:
            thresholds[kind] = max(LEAST_THRESHOLD, lowest / 100)
    return SpanModel(score, thresholds)


def find_spans(documents: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """The documents with ``__text``, ``__base`` and ``__spans`` (all, by kind, then start)."""
    found = base_spans(documents, text)
    if model.score is None or not model.thresholds:
        return found.withColumn("__spans", F.col("__base")).drop("__wide")
    limit = " ".join(f"WHEN '{k}' THEN {t!r}D" for k, t in model.thresholds.items())
    scored = candidates(found).withColumn("__judged", F.expr(
        "transform(__candidates, c -> named_struct('kind', c.kind, "
        f"'start', c.start, 'end', c.end, 'score', {model.score}))"))
    chosen = scored.withColumn("__chosen", F.expr(
        f"filter(__judged, c -> c.score >= CASE c.kind {limit} ELSE 2D END)"))
    # Of overlapping additions those stay that cover most together, then the fewest, then the
    # best. In order of their starts, only the best of what ended before a start matters.
    state = f"struct<cover:int,fewer:int,score:double,last:int,picks:array<{_PLACE}>>"
    added = chosen.withColumn("__added", F.expr(
        "transform(aggregate(array_sort(transform(__chosen, c -> named_struct('start', c.start, "
        "'end', c.end, 'kind', c.kind, 'score', c.score))), array(CAST(named_struct('cover', 0, "
        f"'fewer', 0, 'score', 0D, 'last', 0, 'picks', array()) AS {state})), "
        "(acc, c) -> concat(flatten(transform(array(array_max(filter(acc, s -> s.last <= c.start"
        "))), b -> array(b, named_struct('cover', b.cover + c.end - c.start, 'fewer', b.fewer - 1, "
        "'score', b.score + c.score, 'last', c.end, 'picks', array_append(b.picks, named_struct("
        "'kind', c.kind, 'start', c.start, 'end', c.end)))))), filter(acc, s -> s.last > c.start)), "
        "acc -> array_max(acc).picks), "
        "c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'text', "
        "substr(__text, c.start + 1, c.end - c.start)))"))
    order = "CASE s.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    return added.withColumn("__spans", F.expr(
        f"transform(array_sort(transform(concat(__base, __added), s -> named_struct("
        f"'place', {order}, 'start', s.start, 'span', s))), s -> s.span)")).drop(
            "__wide", "__candidates", "__judged", "__chosen", "__added")


def span_text(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), "
                  "',')")


def redact(documents: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; null texts stay null."""
    rows = documents.select(F.struct(*documents.columns).alias("__row"), F.col(text).alias("__old"))
    found = find_spans(rows, model, "__old")
    placed = F.expr("array_sort(transform(__spans, s -> named_struct('start', s.start, 'end', "
                    "s.end, 'kind', s.kind)))")
    fold = F.expr(
        "aggregate(__order, named_struct('at', 0, 'parts', CAST(array() AS array<string>)), "
        "(acc, s) -> IF(s.start >= acc.at, named_struct('at', s.end, 'parts', array_append("
        "acc.parts, concat(substr(__text, acc.at + 1, s.start - acc.at), '[', upper(s.kind), "
        "']'))), named_struct('at', greatest(acc.at, s.end), 'parts', acc.parts)))")
    cut = found.withColumn("__order", placed).withColumn("__cut", fold)
    redacted = F.concat(F.array_join("__cut.parts", ""), F.expr("substr(__text, __cut.at + 1)"))
    new = F.when(F.col("__old").isNotNull(),
                 F.when(F.size("__order") == 0, F.col("__old")).otherwise(redacted))
    done = cut.select("__row", new.alias("__new"))
    return done.select(*(F.col("__new").alias(c) if c == text else F.col(f"__row.`{c}`")
                         for c in documents.columns))
