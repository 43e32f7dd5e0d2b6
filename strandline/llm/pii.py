"""Personal data by weak supervision, in DataFrame and SQL functions only.

Base spans (email, ip, card, phone) are leftmost, non-overlapping matches of fixed
patterns that pass fixed checks; they are always reported. Beyond them one broad
pattern proposes candidates where no base span is: number groups of seven digits or
more, and strings of twenty or more letters, digits and key characters with a digit.
Labelers vote +1, 0 or -1 on each candidate and, so that there are sure cases, on each
base span of digits:

* a regex labeler (a base span; the form of a key; a number of card length that failed
  the card check, words joined by hyphens),
* a gazetteer labeler (issuer and country prefixes, key prefixes),
* a context labeler (words just before the candidate),
* a shape labeler (how many different characters).

One aggregation counts by (kind, votes, feature value); every factor has a fixed, small
domain, so the table has at most ``TABLE_LIMIT`` rows whatever the corpus. On it,
expectation-maximisation estimates each labeler's reliability over all kinds and each
kind's share of spans, with base spans held at certainty; the posteriors train a naive
Bayes span classifier whose weights become literals of the annotating projection.
Nothing is shuffled but the counts; text is read twice.

Offsets come from running sums that are folded in blocks of the root of their number, and
texts are rewritten block by block, so a text of n matches takes n to the power of 1.5.

Offsets are code points, ends exclusive. Edge cases: null text is the empty text and
has no span; matches that fail a check are dropped without retries; no candidate at all
gives a model that adds nothing; repeated rows are annotated alike; very long texts are
read whole; other columns pass through untouched. Column names that start with ``__``
are reserved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("number", "secret")

# The base patterns. Possessive forms match the same strings as the
# greedy ones and run without recursion; the look-behinds skip starts inside a run
# that has already failed from its first character.
_CLASS = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_CLASS}])|\G)[{_CLASS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Only texts that hold such a string are worth the full pattern.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}

# Key prefixes and context words of the labelers; the context patterns reach less than REACH characters back.
KEY_PREFIXES = r"^(?:sk-|pk-|ghp_|gho_|AKIA|ASIA|xox[abp]-|glpat-|eyJ)"
CONTEXT = r"(?i)(?:token|secret|password|passwd|api[_ -]?key|auth|bearer|e-?mail|mail|phone|tel|telefon|téléphone|teléfono|call|fax|mobile|card|visa|iban|account|konto|ssn|passport|name|contact)[\"'\x20]{0,2}[:=#]?[\"'\x20]{0,3}$"
ISSUERS = "^(?:4[0-9]{15}|5[1-5][0-9]{14}|3[47][0-9]{13}|6011[0-9]{12})$"
COUNTRIES = "^(?:00)?(?:1|33|34|44|49)[0-9]{8,11}$"
KEYS = "^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
WORDY = "^[A-Za-z]{2,}(?:[-_/+][A-Za-z]{2,})+[-_/+]?[0-9]*$"
REACH = 40
CANDIDATE = r"(?<![0-9A-Za-z])[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+(?![A-Za-z0-9])|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+"
CANDIDATE_GUARD = r"[0-9](?:[\x20().-]{0,2}[0-9]){6}|[A-Za-z0-9+/_-]{20}"

LABELERS = 4
THRESHOLD, ROUNDS = 0.5, 200
#: kinds x vote patterns x feature values.
TABLE_LIMIT = len(EXTRA) * 3**LABELERS * 64

_LOCATED = "array<struct<start:int,end:int,m:string,before:string>>"
_NONE = f"cast(array() as {_LOCATED})"


def _bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _fold(values: str, step: str) -> str:
    """All running results of ``step`` (over s and x, from 0) of a short array."""
    return f"aggregate({values}, cast(array() as array<int>), (acc, x) -> concat(acc, array({_bind('coalesce(get(acc, size(acc) - 1), 0)', 's', step)})))"


def running(values: str, step: str) -> str:
    """All running results of an associative ``step`` (over s and x, from 0) of an array, in blocks of the root of its size."""
    blocks = f"transform(sequence(0, (size(v) - 1) div n), b -> {_fold('slice(v, b * n + 1, n)', step)})"
    ends = _fold("transform(w, y -> y[size(y) - 1])", step)
    joined = _bind(ends, "e", f"flatten(transform(w, (y, i) -> transform(y, x -> {_bind('coalesce(get(e, i - 1), 0)', 's', step)})))")
    whole = _bind(values, "v", _bind("cast(ceil(sqrt(size(v))) as int)", "n", _bind(blocks, "w", joined)))
    return f"if(size({values}) = 0, cast(array() as array<int>), {whole})"


def _located(matches: str, gaps: str) -> str:
    """Matches with offsets and the characters just before them, from the matches and the text between them."""
    ends = running(f"transform({matches}, (m, i) -> length(m) + length({gaps}[i]))", "s + x")
    rows = f"transform({matches}, (m, i) -> named_struct('start', at[i] - length(m), 'end', at[i], 'm', m, 'before', right({gaps}[i], {REACH})))"
    return f"if(size({matches}) = 0, {_NONE}, {_bind(ends, 'at', rows)})"


def _rewritten(text: str, spans: str, piece: str) -> str:
    """``text`` with something else in the place of each of ``spans`` (sorted by start).

    ``piece`` gives it from y: from (the furthest end before), start, end (the furthest so far), kind.
    """
    rows = f"transform({spans}, (x, i) -> named_struct('from', coalesce(get(ends, i - 1), 0), 'start', x.start, 'end', ends[i], 'kind', x.kind))"
    part = f"substring({text}, k[0].from + 1, k[size(k) - 1].end - k[0].from)"
    inner = f"array_join(transform(k, y -> concat(substring(part, y.from - k[0].from + 1, greatest(y.start - y.from, 0)), {piece})), '')"
    blocks = f"transform(sequence(0, (size(r) - 1) div n), b -> {_bind('slice(r, b * n + 1, n)', 'k', _bind(part, 'part', inner))})"
    whole = _bind(rows, "r", _bind("cast(ceil(sqrt(size(r))) as int)", "n", f"concat(array_join({blocks}, ''), substring({text}, ends[size(ends) - 1] + 1))"))
    furthest = running(f"transform({spans}, z -> z.end)", "greatest(s, x)")
    return f"if(size({spans}) = 0, {text}, {_bind(furthest, 'ends', whole)})"


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_LUHN = """(aggregate(sequence(1, length({d})), 0, (s, i) -> s + if(i % 2 = 1, cast(substring({d}, -i, 1) as int),
    2 * cast(substring({d}, -i, 1) as int) - if(cast(substring({d}, -i, 1) as int) > 4, 9, 0))) % 10 = 0)"""
CHECKS = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> coalesce(try_cast(substring(concat('0', trim(leading '0' from p)), 1, 5) as int) <= 255, false))",
    "card": "if(length(translate(x.m, ' -', '')) between 14 and 19, " + _LUHN.format(d="translate(x.m, ' -', '')") + ", false)",
    "phone": f"length({_DIGITS}) between 10 and 15",
}


def _matched(docs: DataFrame, kind: str, text: str, pattern: str, guard: Column) -> DataFrame:
    """``docs`` plus __kind, the located matches of a pattern."""
    none = F.array().cast("array<string>")
    out = docs.withColumn("__go", guard).withColumn("__m", F.when(F.col("__go"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    out = out.withColumn("__g", F.when(F.size("__m") > 0, F.split(text, pattern, -1)).otherwise(none))
    located = _located("__m", "__g")
    return out.withColumn(f"__{kind}", F.expr(f"filter({located}, x -> {CHECKS[kind]})" if kind in CHECKS else located)).drop("__go", "__m", "__g")


def _found(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with __text, the base spans __email .. __phone, all of them as __base, and the candidates elsewhere as __cand."""
    out = docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE)):
        out = _matched(out, kind, "__text", pattern, F.col("__text").contains("@") if kind == "email" else F.col("__text").rlike(GUARDS[kind]))
    base = ", ".join(f"transform(__{k}, x -> named_struct('start', x.start, 'rank', {i}, 'end', x.end, 'kind', '{k}'))" for i, k in enumerate(KINDS))
    out = out.withColumn("__base", F.expr(f"array_sort(concat({base}))"))
    blank = "repeat('\\u0001', y.end - greatest(y.start, y.from))"
    out = out.withColumn("__rest", F.expr(_rewritten("__text", "__base", blank)))
    return _matched(out, "cand", "__rest", CANDIDATE, F.col("__rest").rlike(CANDIDATE_GUARD))


def _judged(found: DataFrame) -> DataFrame:
    """Adds __judged: kind, votes and feature values of each candidate and each base span of digits."""
    digits, n = _DIGITS, f"length({_DIGITS})"
    quote = lambda p: "'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'"
    distinct = lambda of: f"size(array_distinct(split({of}, '')))"
    letters = "x.m rlike '[A-Za-z]'"
    kind = f"if({letters}, 'secret', 'number')"
    regex = (
        f"case when x.over then 1 when {letters} then case when x.m rlike '{KEYS}' or x.m rlike {quote(KEY_PREFIXES)} then 1 when x.m rlike '{WORDY}' then -1 else 0 end"
        f" when {n} between 9 and 13 then 0 else -1 end"
    )
    gazetteer = (
        f"case when {letters} then case when x.m rlike {quote(KEY_PREFIXES)} then 1 when x.m rlike '{KEYS}' then 0 else -1 end"
        f" when x.m rlike '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$' then 0 when {digits} rlike '{ISSUERS}' or {digits} rlike '{COUNTRIES}' then 1 else -1 end"
    )
    context = f"if(x.before rlike {quote(CONTEXT)}, 1, -1)"
    shape = f"if({letters}, if({distinct('x.m')} >= 10, 1, -1), if({distinct(digits)} >= 5, 1, -1))"
    features = [
        "concat('len', cast(least(floor(log2(length(x.m))), 9) as string))",
        f"concat('digits', cast(floor(4 * {n} / length(x.m)) as string))",
        "concat('sep', case when not x.m rlike '[ ().-]' then 'none' when x.m rlike '^[^().-]*$' then 'space' when x.m rlike '^[^ ().]*$' then 'hyphen' when x.m rlike '^[^ ()-]*$' then 'dot' else 'mixed' end)",
        "concat('case', case when x.m rlike '^[^A-Z]*$' then 'lower' when x.m rlike '^[^a-z]*$' then 'upper' else 'both' end)",
        "concat('left', case when x.before = '' then 'edge' when x.before rlike '[=:][ \"\\']{0,2}$' then 'assign' when x.before rlike ' $' then 'space' else 'other' end)",
        f"concat('rgx', {regex})", f"concat('ctx', {context})", f"concat('gaz', {gazetteer})", f"concat('shp', {shape})",
    ]
    known = "concat(" + ", ".join(f"transform(__{k}, x -> named_struct('start', x.start, 'end', x.end, 'm', x.m, 'before', x.before, 'over', true))" for k in KINDS[1:])
    every = known + ", transform(__cand, x -> named_struct('start', x.start, 'end', x.end, 'm', x.m, 'before', x.before, 'over', false)))"
    judged = f"""transform({every}, x -> named_struct('start', x.start, 'end', x.end, 'kind', {kind}, 'over', x.over,
        'votes', concat_ws(',', {regex}, {gazetteer}, {context}, {shape}), 'features', array({', '.join(features)})))"""
    return found.withColumn("__judged", F.expr(judged))


#: How often a labeler is assumed right, and in how many votes, before any is counted.
RIGHT, OF = 2.0, 3.0


def learn_reliabilities(patterns: dict[tuple, int], sure: set[tuple] = frozenset()) -> tuple[dict[tuple, float], list[tuple[float, float]], dict[str, float]]:
    """EM over (kind, vote, vote, ...) patterns.

    The posterior of each pattern, per labeler P(votes + | span) and P(votes + | no span) over all
    kinds, and each kind's share of spans. Patterns that are ``sure`` are spans.
    """
    post = {v: 1.0 if v in sure else min(0.9, max(0.1, 0.5 + 0.2 * sum(v[1:]))) for v in patterns}
    rates: list[tuple[float, float]] = []
    shares: dict[str, float] = {}
    for _ in range(ROUNDS):
        shares = {}
        for kind in {v[0] for v in patterns}:
            mine = [(n, post[v]) for v, n in patterns.items() if v[0] == kind and v not in sure]
            shares[kind] = (1 + sum(n * q for n, q in mine)) / (2 + sum(n for n, _ in mine))
        rates = []
        for j in range(1, LABELERS + 1):
            up, of_up, down, of_down = RIGHT, OF, OF - RIGHT, OF
            for v, n in patterns.items():
                if v[j]:
                    of_up, of_down = of_up + n * post[v], of_down + n * (1 - post[v])
                    if v[j] > 0:
                        up, down = up + n * post[v], down + n * (1 - post[v])
            rates.append((up / of_up, down / of_down))
        moved = 0.0
        for v in patterns:
            if v in sure:
                continue
            odds = math.log(shares[v[0]] / (1 - shares[v[0]]))
            for vote, (a, b) in zip(v[1:], rates):
                if vote:
                    odds += math.log(a / b) if vote > 0 else math.log((1 - a) / (1 - b))
            new = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            moved, post[v] = max(moved, abs(new - post[v])), new
        if moved < 1e-9:
            break
    return post, rates, shares


class SpanModel:
    """Weights of the span classifier: (kind, feature value) -> log odds, and a bias for each kind; the labelers' reliabilities."""

    def __init__(self, bias: dict[str, float], weights: dict[tuple[str, str], float], reliabilities: list[tuple[float, float]]):
        self.bias, self.weights, self.reliabilities = bias, weights, reliabilities

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text") -> SpanModel:
        # an inner explode would have its emptiness test pushed down, and all of the above with it
        judged = _judged(_found(docs.select(F.col(text_col).alias("__t")), "__t")).select(F.explode_outer("__judged").alias("c")).where("c is not null")
        table = (
            judged.select("c.kind", "c.votes", "c.over", F.explode(F.concat(F.col("c.features"), F.array(F.lit("")))).alias("feature"))
            .groupBy("kind", "votes", "over", "feature").agg(F.count(F.lit(1)).alias("n"))
        )
        rows = table.collect()  # at most TABLE_LIMIT rows: every factor has a fixed domain
        pattern = lambda r: (r["kind"], *map(int, r["votes"].split(",")), *(["base"] if r["over"] else []))
        patterns = {pattern(r): r["n"] for r in rows if r["feature"] == ""}
        post, reliabilities, shares = learn_reliabilities(patterns, {v for v in patterns if v[-1] == "base"})
        bias, weights = {}, {}
        for kind, share in shares.items():
            # what candidates of this kind look like with and without a span; the share of spans is that of candidates, not of base spans
            mine = [(post[pattern(r)], r["feature"], r["n"], r["over"]) for r in rows if r["kind"] == kind]
            yes, no = 1 + sum(n * q for q, f, n, _ in mine if f == ""), 1 + sum(n * (1 - q) for q, f, n, _ in mine if f == "")
            bias[kind] = math.log(share / (1 - share))
            for feature in {f for _, f, _, _ in mine if f}:
                a = 0.5 + sum(n * q for q, f, n, _ in mine if f == feature)
                b = 0.5 + sum(n * (1 - q) for q, f, n, _ in mine if f == feature)
                weights[kind, feature] = math.log(a / yes / (b / no))
        return cls(bias, weights, reliabilities)

    def _added(self) -> Column:
        """Spans that the classifier adds."""
        if not self.bias:
            return F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
        pairs = ", ".join(f"'{k} {f}', {w:.9f}D" for (k, f), w in sorted(self.weights.items())) or "'', 0D"
        bias = ", ".join(f"'{k}', {w:.9f}D" for k, w in sorted(self.bias.items()))
        limit = math.log(THRESHOLD / (1 - THRESHOLD))
        odds = f"aggregate(c.features, coalesce(map({bias})[c.kind], -99D), (s, f) -> s + coalesce(map({pairs})[concat(c.kind, ' ', f)], 0D))"
        ranks = " ".join(f"when '{k}' then {len(KINDS) + i}" for i, k in enumerate(EXTRA))
        return F.expr(
            f"transform(filter(__judged, c -> not c.over and {odds} > {limit}D), c -> named_struct('start', c.start, 'rank', case c.kind {ranks} end, 'end', c.end, 'kind', c.kind))"
        )

    def annotate(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` plus __text, __base and __spans (array of start, rank, end, kind in order)."""
        out = _judged(_found(docs, text_col)).withColumn("__added", self._added())
        return out.withColumn("__spans", F.expr("array_sort(concat(__base, __added))"))


def _joined(spans: str) -> str:
    return f"concat_ws(',', transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)))"


def find_spans(docs: DataFrame, text_col: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``docs`` plus n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added."""
    model = model or SpanModel.fit(docs, text_col)
    counts = {f"n_{k}": F.size(f"__{k}").cast("long") for k in KINDS}
    digests = {"base_sha256": F.sha2(F.expr(_joined("__base")).cast("binary"), 256), "spans": F.expr(_joined("__spans")), "n_added": F.size("__added").cast("long")}
    named = counts | digests
    kept = [c for c in docs.columns if c not in named]
    return model.annotate(docs, text_col).select(*kept, *[v.alias(k) for k, v in named.items()])


def mask(docs: DataFrame, text_col: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; n_chars, if there, follows the text."""
    model = model or SpanModel.fit(docs, text_col)
    masked = _rewritten("__text", "__spans", "if(y.start >= y.from, concat('[', upper(y.kind), ']'), '')")
    columns = docs.columns
    out = model.annotate(docs, text_col).withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.expr(masked)))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length(F.coalesce(text_col, F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
