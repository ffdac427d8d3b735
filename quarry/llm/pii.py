"""Personal data by candidate gradient boosting (operator 7), in SQL functions alone.

Generators. Four base patterns (email, ip, card, phone) yield checked spans; wider generators
propose overlapping candidates with high recall: spelled-out e-mail addresses, dotted numbers,
and any run of seven or more digits with separators, as a phone and as a card. Matches are found
by regexp_replace, which sets marks around them; splitting at the marks gives the matches and
their offsets (in code points), with prefix sums in blocks so that a text with very many matches
does not cost their square.

Rules. A candidate of a wide form that its rule in ``RULES`` proves by format, or by a cue word right
before it, is always added, however common the form is and whether or not its kind has a model.

Trees. Candidates that overlap a base span or pass the rule are positive examples; the others are
unlabelled and count against the precision, so it is a lower bound. Boosted trees learn them from format (lengths, groups, separators, characters beside the span)
and context (cue words before it), without the features that the base checks test. A threshold
is calibrated on held-out candidates for a precision of at least ``PRECISION``; candidates above
it that overlap no base span of the kind are added. Base spans always stay. Trees and thresholds
are made from every candidate of all texts, counted by Spark: one half fits, the other is held out.

Defined results: null counts as empty and has no spans; repeated rows agree; an empty table
gives no rows; a text of any length is searched whole. A private-use character that serves as
the mark may occur in a text: it is no part of any pattern and is replaced first by another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import boosting
from quarry.llm.common import discard, materialize, read_table

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.98
MARK, OTHER_MARK = "\ue000", "\ue001"
BLOCK = 512
CONTEXT = 24

# Base patterns. Possessive repeats and the look-behinds change no match; they keep the search
# linear and free of recursion on long runs.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a pattern to match at all: a cheap test before the pattern.
NEEDS = {"email": "contains({t}, '@')", "ip": "{t} rlike '[0-9][.][0-9]'", "card": "{t} rlike '[0-9]{{2}}|[0-9][ -][0-9]'",
         "phone": "contains({t}, '+')"}
DIGITS = "translate({m}, translate({m}, '0123456789', ''), '')"
LUHN = ("aggregate(sequence(1, length({d})), 0, (a, i) -> a + if(i % 2 = 1, int(substring(reverse({d}), i, 1)), "
        "int(substring('0246813579', int(substring(reverse({d}), i, 1)) + 1, 1)))) % 10 = 0")
CHECKS = {
    "email": "true",
    "ip": "forall(split({m}, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(concat('0', ltrim('0', p)) as int), 256) <= 255)",
    "card": "length({d}) between 12 and 19 and " + LUHN,
    "phone": "length({d}) between 9 and 15",
}

# Wider generators: name -> (kinds it proposes, pattern, what the text must hold).
WIDE = {
    "address": (["email"], r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}(?: ?[(\[] ?at ?[)\]] ?| at |@)[a-z0-9-]{1,63}"
                           r"(?:(?: ?[(\[] ?dot ?[)\]] ?| dot |\.)[a-z0-9-]{1,63}){1,6}",
                "contains({t}, '@') or lower({t}) rlike '[(\\\\[ ]at[)\\\\] ]'"),
    "dotted": (["ip"], r"(?<![0-9.])[0-9]{1,3}(?:[.,] ?[0-9]{1,3}){3}(?![0-9.])", "{t} rlike '[0-9][.,]'"),
    "number": (["phone", "card"], r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,24}(?![0-9A-Za-z])",
               "{t} rlike '[0-9].?[0-9]'"),
}

# Rules for the wide forms. Spelled-out addresses: "at" in brackets, or a spelled-out "dot", which without
# brackets needs a usual last label ("at each dot on" is prose). Numbers: a cue word just before, and the
# base check of the kind without its format ('+', separators).
_CUE = "{c}.l rlike '(?i)\\\\b(%s)\\\\b[a-z .:]{{0,12}}$'"
RULES = {
    "email": "{c}.m rlike '(?i)[(\\\\[] ?(at|dot) ?[)\\\\]]| dot (com|org|net|edu|gov|info|io|eu|de|fr|es|uk)$'",
    "ip": _CUE % "ip|host|server|addr|address" + " and forall(split({c}.m, '[^0-9]+'), x -> int(x) <= 255)",
    "card": "length({c}.d) between 12 and 19 and " + _CUE % "card|visa|mastercard|carte|tarjeta" + " and " + LUHN.replace("{d}", "{c}.d"),
    "phone": "length({c}.d) between 9 and 15 and " + _CUE % "tel|phone|telephone|call|fax|mobile|mobil|cell",
}

SPAN = "array<struct<start:bigint,end:bigint,m:string,l:string,r:string>>"

# Features of a candidate c (m: match, l, r: context), without what the base checks test.
FEATURES = {
    "length": "length({c}.m)",
    "digits": "length({c}.d)",
    "spaces": "length({c}.m) - length(replace({c}.m, ' ', ''))",
    "hyphens": "length({c}.m) - length(replace({c}.m, '-', ''))",
    "dots": "length({c}.m) - length(replace({c}.m, '.', ''))",
    "brackets": "length({c}.m) - length(translate({c}.m, '()[]', ''))",
    "groups": "size(split({c}.m, '[^0-9]+'))",
    "longest_group": "aggregate(split({c}.m, '[^0-9]+'), 0, (a, x) -> greatest(a, length(x)))",
    "last_group": "length(substring_index(translate({c}.m, ' .()', '----'), '-', -1))",
    "first_digit": "coalesce(try_cast(left({c}.d, 1) as int), 0)",
    "labels": "size(split({c}.m, '[.]|dot'))",
    "space_before": "if({c}.l = '' or right({c}.l, 1) rlike '[ \\\\n\\\\t]', 1, 0)",
    "space_after": "if({c}.r = '' or left({c}.r, 1) rlike '[ \\\\n\\\\t.,;]', 1, 0)",
    "digits_around": "length(translate(concat({c}.l, {c}.r), translate(concat({c}.l, {c}.r), '0123456789', ''), ''))",
    "cue_phone": "if(lower({c}.l) rlike 'tel|phone|call|fax|mobil', 1, 0)",
    "cue_card": "if(lower({c}.l) rlike 'card|visa|pay|carte|tarjeta', 1, 0)",
    "cue_mail": "if(lower({c}.l) rlike 'mail|contact|write', 1, 0)",
    "cue_address": "if(lower({c}.l) rlike 'ip|host|server|addr', 1, 0)",
}


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _parts(pattern: str, needs: str) -> str:
    """SQL: the text split at its matches; odd places are the matches."""
    marked = f"regexp_replace(t, {_quoted(pattern)}, '{MARK}$0{MARK}')"
    return f"if({needs.format(t='t')}, split({marked}, '{MARK}', -1), array(t))"


def _spans(parts: str) -> str:
    """SQL: the matches of ``parts`` with offsets and context."""
    starts = (f"aggregate(transform(sequence(0, cast((size({parts}) - 1) div {BLOCK} as int)), b -> "
              f"aggregate(slice({parts}, b * {BLOCK} + 1, {BLOCK}), 0L, (a, x) -> a + char_length(x))), "
              "named_struct('at', 0L, 'all', cast(array() as array<bigint>)), "
              "(a, x) -> named_struct('at', a.at + x, 'all', array_append(a.all, a.at)), a -> a.all)")
    one = (f"named_struct('start', a.at, 'end', a.at + char_length(x), 'm', x, 'l', right(get({parts}, a.i - 1), {CONTEXT}), "
           f"'r', left(get({parts}, a.i + 1), {CONTEXT}))")
    block = (f"aggregate(slice({parts}, b * {BLOCK} + 1, {BLOCK}), "
             f"named_struct('at', s, 'i', b * {BLOCK}, 'out', cast(array() as {SPAN})), (a, x) -> named_struct("
             f"'at', a.at + char_length(x), 'i', a.i + 1, 'out', if(a.i % 2 = 1, array_append(a.out, {one}), a.out)), a -> a.out)")
    return f"if(size({parts}) < 2, cast(array() as {SPAN}), flatten(transform({starts}, (s, b) -> {block})))"


def find_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as struct ``row`` with ``base`` (kind number, start, end) and ``wide`` (the same
    with ``hit``: overlaps a base span, ``rule``: passes the rule of its kind, and the features)."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.translate(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")), MARK, OTHER_MARK).alias("t"))
    split = {f"p_{k}": _parts(BASE[k], NEEDS[k]) for k in KINDS}
    split |= {f"q_{k}": _parts(pattern, needs) for k, (_, pattern, needs) in WIDE.items()}
    rows = rows.select("row", *[F.expr(v).alias(k) for k, v in split.items()])
    rows = rows.select("row", *[F.expr(_spans(k)).alias("s" + k) for k in split])
    with_digits = "transform({s}, x -> named_struct('start', x.start, 'end', x.end, 'm', x.m, 'l', x.l, 'r', x.r, 'd', " + \
        DIGITS.format(m="x.m") + "))"
    rows = rows.select("row", *[F.expr(with_digits.format(s="s" + k)).alias(k) for k in split])
    base = [f"transform(filter(p_{k}, x -> {CHECKS[k].format(m='x.m', d='x.d')}), "
            f"x -> named_struct('start', x.start, 'kind', {i}, 'end', x.end))" for i, k in enumerate(KINDS)]
    rows = rows.select("row", F.expr(f"array_sort(concat({', '.join(base)}))").alias("base"), *[f"q_{k}" for k in WIDE])
    features = ", ".join(f"'{k}', double({v.format(c='x')})" for k, v in FEATURES.items())
    wide = [f"transform(q_{k}, x -> named_struct('start', x.start, 'kind', {KINDS.index(kind)}, 'end', x.end, "
            f"'hit', exists(base, b -> b.kind = {KINDS.index(kind)} and b.start < x.end and x.start < b.end), "
            f"'rule', coalesce({RULES[kind].format(c='x')}, false), {features}))"
            for k, (kinds, _, _) in WIDE.items() for kind in kinds]
    return rows.select("row", "base", F.expr(f"concat({', '.join(wide)})").alias("wide"))


def fit_models(found: DataFrame, sample: int | None = None, precision: float = PRECISION) -> dict[int, tuple]:
    """{kind number: (trees, threshold)} from every candidate; half of them are held out for the
    threshold. A kind without a threshold of that precision has no entry. ``sample`` bounded the
    candidates once; callers may still give it, and it changes nothing."""
    rows = found.where(F.size("wide") > 0).select(F.explode("wide").alias("w"))
    rows = rows.select("w.kind", F.expr("w.hit or w.rule").cast("long").alias("hit"), *[f"w.{k}" for k in FEATURES])
    cuts = boosting.quantile_cuts(rows, list(FEATURES))
    if not cuts:
        return {}
    cells = materialize(boosting.counted(rows, list(FEATURES), cuts), "pii-cells")
    fitted, scored = boosting.fit_all(cells, cuts, trees=20)
    models = {}
    for kind, counts in boosting.score_counts(scored).items():
        limit = boosting.threshold_for_precision(counts[:, 0], counts[:, 2], precision, rows=counts[:, 1])
        if limit is not None:
            models[kind] = (fitted[kind], limit)
    discard(*([cells, scored] if fitted else [cells]))
    return models


def select_spans(found: DataFrame, models: dict[int, tuple]) -> DataFrame:
    """Adds ``spans``: the base spans and the candidates that pass their kind's rule or are above its
    threshold, and overlap no base span of their kind."""
    chosen = [f"w.kind = {kind} and {model.sql([f'w.{k}' for k in FEATURES])} >= {limit!r}D"
              for kind, (model, limit) in models.items()]
    test = " or ".join(f"({c})" for c in chosen) or "false"
    added = f"transform(filter(wide, w -> not w.hit and (w.rule or {test})), w -> named_struct('start', w.start, 'kind', w.kind, 'end', w.end))"
    return found.withColumn("spans", F.expr(f"array_sort(array_distinct(concat(base, {added})))"))


def _listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat(get(array({names}), x.kind), ':', x.start, ':', x.end)), ',')"


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by its kind in brackets; all
    other columns and texts without spans unchanged (null stays null)."""
    found = find_candidates(docs, text)
    # no filter before the write: pushed below the projections, it would repeat the search in every place
    models = fit_models(materialize(found.select("wide"), "pii-candidates"))
    rows = select_spans(found, models)
    runs = ("aggregate(spans, cast(array() as array<struct<start:bigint,kind:int,end:bigint>>), (a, x) -> "
            "if(size(a) > 0 and x.start < element_at(a, -1).end, "
            "concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'kind', element_at(a, -1).kind, "
            "'end', greatest(x.end, element_at(a, -1).end)))), array_append(a, x)))")
    rows = rows.select("row", F.expr(runs).alias("runs"))
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    t = f"row.`{text}`"
    pieces = (f"concat(transform(runs, (x, i) -> concat(substring({t}, int(coalesce(get(runs, i - 1).end, 0L)) + 1, "
              f"int(x.start - coalesce(get(runs, i - 1).end, 0L))), get(array({names}), x.kind))), "
              f"array(substring({t}, int(element_at(runs, -1).end) + 1)))")
    masked = F.expr(f"if(size(runs) = 0, {t}, array_join({pieces}, ''))")
    return rows.select(*[masked.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: base spans counted and digested, and all spans."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialize(find_candidates(docs).select(F.struct("row.doc_id").alias("row"), "base", "wide"), "pii-spans")
    rows = select_spans(found, fit_models(found))
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = {i})))").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"),
                       F.expr(_listed("spans")).alias("spans"))
