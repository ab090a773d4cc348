"""Personal data by candidate gradient boosting, in DataFrame functions only.

Strict patterns give the base spans.  High-recall generators propose further
spans, which may overlap the base and each other: spelt-out e-mail addresses,
and digit groups with any separators, read as an IP address, a card or a phone
number.  A candidate's normal form (spelt-out marks undone, separators
stripped; check digit, octets, digit counts, grouping) and context (the words
before it, the characters around it) are bits of a small code.  What only base
spans have, such as the '+' of a telephone number, is no bit of its own.
Boosted trees are fitted to the codes: the corpus is counted by code (at most
CODES rows leave the cluster, whatever its size).  Positives hold a base span
of their kind or are well-formed in normal form; negatives are ill-formed, part
of a longer word, or overlap only base spans of another kind.  Well-formed
national telephone numbers with neither an area code in brackets nor a telling
context have no label: they are scored, but neither fitted nor calibrated on.  The trees become nested CASE
expressions, and each kind's score from which on spans are redacted is
calibrated to a precision on candidates of documents that were held out.

Positions are running sums over a document's matches, and whether a candidate
meets a base span is read from running extremes over its spans in order: both
are windows over small rows, one for each match, so texts never move and a
document with very many spans costs a sort of them.

Defined cases: null text is the empty text and has no spans; offsets are code
points, end exclusive; texts are searched whole; rows are judged one by one, so equal rows get equal results; a corpus
without candidates fits no trees and has the base spans only; other columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace, no_null

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns.  A match starts where the last one ended or where no
# such character stands before, and repetitions that cannot give anything back
# are possessive: the same matches, without trying each start of a long run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts in which a pattern cannot match are not searched.
NEEDS = {"email": "instr(text, '@') > 0", "ip": "text rlike '[0-9][.][0-9]'", "card": "text rlike '[0-9][ -]?[0-9]'", "phone": "text rlike '[+][0-9]'"}
WIDE_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?:(?:\.| \. | ?(?:\(dot\)|\[dot\]|\{dot\}) ?)[A-Za-z0-9-]++)*+"
WIDE_DIGITS = r"[+(]?[0-9](?:(?![.,]\x20)[\x20().,/\[\]-]{0,3}+[0-9])++"
WIDE_NEEDS = {"email": "instr(text, '@') > 0 or instr(text, 'at)') > 0 or instr(text, 'at]') > 0 or instr(text, 'at}') > 0", "digits": "text rlike '[0-9][^A-Za-z]{0,3}[0-9]'"}
CONTEXT_WORDS = "mail|phone|tel|call|fax|mobile|card|visa|credit|addr|host|server| ip"
CONTEXT_CHARS = 30

#: Feature bits below the kind, least first.
BITS = ("valid", "shape", "context", "before", "after", "sixteen")
CODES = len(KINDS) << len(BITS)
ROUNDS, RATE, DEPTH = 24, 0.4, 2
PRECISION = 0.95

#: Every so many-th document is held out for calibration; kinds with fewer held-out labels than this are calibrated on all, and with
#: fewer for all kinds none are held out.
FOLDS, LEAST_HELD = 4, 40


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(name: str, k: int) -> str:
    """array of (pattern, nth, gap before, match, characters around) from the pieces p_ and matches m_ of a split text."""
    p, m = f"p_{name}", f"m_{name}"
    zipped = f"arrays_zip({p}, {m}, slice({p}, 2, size({p})), slice({m}, 2, size({p})), concat(array(''), {p}), concat(array(''), {m}))"
    before = f"right(concat(right(x.`4`, {CONTEXT_CHARS}), right(x.`5`, {CONTEXT_CHARS}), right(x.{p}, {CONTEXT_CHARS})), {CONTEXT_CHARS})"
    after = "left(concat(left(x.`2`, 1), coalesce(left(x.`3`, 1), '')), 1)"
    return f"""transform(filter({zipped}, x -> x.{m} IS NOT NULL), (x, i) -> named_struct('pattern', {k}, 'nth', i, 'gap', length(x.{p}),
        'm', x.{m}, 'before', {before}, 'after', {after}))"""


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn_sql(digits: str) -> str:
    """Whether a string of digits passes the Luhn check: every second digit from the right is doubled."""
    place = f"CAST(substring({digits}, length({digits}) - i, 1) AS INT)"
    return f"(aggregate(sequence(0, length({digits}) - 1), 0, (t, i) -> t + CASE WHEN i % 2 = 0 THEN {place} WHEN {place} > 4 THEN 2 * {place} - 9 ELSE 2 * {place} END) % 10 = 0)"


def _octets(x: str) -> str:
    return f"({x} rlike '^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:[^0-9]+0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){{3}}$')"


BASE_VALID = {
    "email": "true",
    "ip": _octets("m"),
    "card": f"(length({_digits('m')}) BETWEEN 16 AND 19 AND {luhn_sql(_digits('m'))})",
    "phone": f"(length({_digits('m')}) BETWEEN 8 AND 15)",
}


def _rlike(x: str, pattern: str) -> str:
    return f"({x} rlike {_quote(pattern)})"


#: A candidate e-mail address with its spelt-out marks undone.
PLAIN_EMAIL = f"regexp_replace(regexp_replace(m, {_quote(r' ?(?:@|[(]at[)]|\[at\]|[{]at[}]) ?')}, '@'), {_quote(r' [.] | ?(?:[(]dot[)]|\[dot\]|[{]dot[}]) ?')}, '.')"
_CONTEXT = f"lower(before) rlike '{CONTEXT_WORDS}'"
#: Telephone numbers without '+': an area code in brackets, groups of 3, 3 and 4, or a leading zero (in one run only where the context says so).
NATIONAL = (
    r"^(?:[0-9]{1,3}[ .-]?)?[(](?!(?:19|20)[0-9]{2}[)])0?[0-9]{1,5}[)][ ./-]{0,2}[0-9]{2,8}(?:[ .-][0-9]{2,5})*$",
    r"^(?:[0-9]{1,3}[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}$",
    r"^0[0-9]{1,4}[ ./-][0-9]{3,8}(?:[ .-][0-9]{2,5})*$",
    r"^0[0-9](?:[ .-][0-9]{2}){4}$",
)
SHAPES = {
    "email": _rlike(PLAIN_EMAIL, r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+$"),
    "ip": _rlike("m", r"^[0-9]+(?:(?:[.]|\[[.]\]|[(][.][)]| [.] )[0-9]+){3}$"),
    "card": f"({_rlike('m', r'^[0-9](?:[ -]?[0-9])+$')} OR {_rlike('m', r'^[0-9]{4}([^0-9]{1,3})[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1?[0-9]{1,3})?$')})",
    "phone": f"(startswith(m, '+') OR {' OR '.join(_rlike('m', p) for p in NATIONAL)} OR m rlike '^0[0-9]{{8,12}}$' AND {_CONTEXT})",
}
#: Well-formed candidates that count as positives without a base span.  Other national numbers have no label: they are scored only.
STRONG = {"email": "true", "ip": "true", "card": "true", "phone": f"(startswith(m, '(') OR {_CONTEXT})"}


def _bits_sql(kind: str) -> str:
    valid = BASE_VALID[kind] if kind != "email" else _rlike(PLAIN_EMAIL, "[.][A-Za-z]{2,}$")
    around = {"before": "right(before, 1) rlike '[A-Za-z0-9]'", "after": "after rlike '[A-Za-z0-9]'"}
    tests = {"valid": valid, "shape": SHAPES[kind], "context": _CONTEXT, "sixteen": f"length({_digits('m')}) = 16", **around}
    return " + ".join([str(KINDS.index(kind) << len(BITS)), *(f"CASE WHEN {tests[b]} THEN {1 << k} ELSE 0 END" for k, b in enumerate(BITS))])


#: Of a candidate: true, false or null.  ``own_end`` is the end of the next base span of its kind, ``meets`` whether it overlaps any.
_bit = {b: 1 << k for k, b in enumerate(BITS)}
_LABEL = f"""CASE WHEN base THEN NULL WHEN own_end <= e THEN true
    WHEN meets OR (code & {_bit["valid"] | _bit["shape"]}) <> {_bit["valid"] | _bit["shape"]} OR (code & {_bit["before"] | _bit["after"]}) <> 0 THEN false
    WHEN strong THEN true END"""


def find_matches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, matches) of every row: all matches of the patterns in order, with what stands around them."""
    patterns = {**{k: (BASE[k], NEEDS[k]) for k in KINDS}, "wide_email": (WIDE_EMAIL, WIDE_NEEDS["email"]), "wide_digits": (WIDE_DIGITS, WIDE_NEEDS["digits"])}
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text"))
    cut = []
    for name, (pattern, needs) in patterns.items():
        rx = _quote(pattern)
        cut += [F.expr(f"CASE WHEN {needs} THEN split(text, {rx}, -1) ELSE array('') END").alias(f"p_{name}"), F.expr(f"CASE WHEN {needs} THEN regexp_extract_all(text, {rx}, 0) ELSE CAST(array() AS array<string>) END").alias(f"m_{name}")]
    parts = ", ".join(_matches(name, k) for k, name in enumerate(patterns))
    return docs.select("row", "id", *cut).select("row", "id", F.expr(f"concat({parts})").alias("matches"))


def find_spans(matches: DataFrame) -> DataFrame:
    """(row, id, kind, s, e, base, code, meets, y): base spans, and candidates with their code and label; each row also gives one of nulls, so that none is lost."""
    rows = matches.select("row", "id", F.expr("explode(array_append(matches, NULL))").alias("x")).select("row", "id", "x.*").repartition("row")
    ends = F.sum(F.col("gap") + F.length("m")).over(W.partitionBy("row", "pattern").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)).cast("int")
    rows = rows.withColumn("e", ends).withColumn("s", F.col("e") - F.length("m"))
    # the same digits may be read as several kinds: the candidates overlap
    length, wide = f"length({_digits('m')})", len(KINDS)
    valid = " ".join(f"WHEN {k} THEN CASE WHEN {BASE_VALID[kind]} THEN array({k}) END" for k, kind in enumerate(KINDS))
    kinds = f"""CASE pattern {valid} WHEN {wide} THEN array(0) WHEN {wide + 1} THEN filter(array(
        CASE WHEN {length} BETWEEN 4 AND 12 AND length(regexp_replace(m, '[0-9]+', '')) >= 3 THEN 1 END, CASE WHEN {length} BETWEEN 13 AND 19 THEN 2 END,
        CASE WHEN {length} BETWEEN 7 AND 15 THEN 3 END), k -> k IS NOT NULL) END"""
    rows = rows.withColumn("kind", F.explode_outer(F.expr(kinds))).where("kind IS NOT NULL OR pattern IS NULL").withColumn("base", F.expr(f"kind IS NOT NULL AND pattern < {wide}"))
    code = " ".join(f"WHEN kind = {k} THEN {_bits_sql(kind)}" for k, kind in enumerate(KINDS))
    strong = " ".join(f"WHEN kind = {k} THEN {STRONG[kind]}" for k, kind in enumerate(KINDS))
    rows = rows.select("row", "id", "kind", "s", "e", "base", F.expr(f"CASE WHEN base THEN NULL {code} END").cast("int").alias("code"), F.expr(f"CASE WHEN base THEN NULL {strong} END").alias("strong"))
    own_base = F.when(F.col("base"), F.struct("s", "e"))
    rows = rows.withColumns({
        "last_end": F.max(F.when(F.col("base"), F.col("e"))).over(W.partitionBy("row").orderBy("s")),
        "next_start": F.min(F.when(F.col("base"), F.col("s"))).over(W.partitionBy("row").orderBy(F.desc("s"))),
        # base spans of a kind do not overlap, so of those that begin later the next one ends first
        "own_end": F.min(own_base).over(W.partitionBy("row", "kind").orderBy(F.desc("s")))["e"],
    })
    rows = rows.withColumn("meets", F.expr("coalesce(last_end > s OR next_start < e, last_end > s, next_start < e, false)"))
    return rows.select("row", "id", "kind", "s", "e", "base", "code", "meets", F.expr(_LABEL).alias("y"))


class BoostedTrees:
    """Additive trees over the bits of a code: nested (bit, if set, if not set) with numbers as leaves."""

    def __init__(self, bias: float, trees: list):
        self.bias, self.trees = bias, trees
        self.thresholds: dict[int, float] = {}  # by kind; a kind without one adds nothing

    @staticmethod
    def _grow(rows: list[tuple], depth: int):
        """Newton step on (code, weight of rows, gradient, curvature), split where the gain is largest."""

        def leaf(part):
            return RATE * sum(g for _, _, g, _ in part) / (sum(h for _, _, _, h in part) + 1.0)

        def gain(part):
            return sum(g for _, _, g, _ in part) ** 2 / (sum(h for _, _, _, h in part) + 1.0)

        best = None
        for bit in range(CODES.bit_length() - 1) if depth else ():
            on, off = [r for r in rows if r[0] >> bit & 1], [r for r in rows if not r[0] >> bit & 1]
            if on and off and (best is None or gain(on) + gain(off) > best[0] + 1e-12):
                best = gain(on) + gain(off), bit, on, off
        if best is None or best[0] <= gain(rows) + 1e-9:
            return leaf(rows)
        return best[1], BoostedTrees._grow(best[2], depth - 1), BoostedTrees._grow(best[3], depth - 1)

    @staticmethod
    def _value(tree, code: int) -> float:
        while isinstance(tree, tuple):
            tree = tree[1] if code >> tree[0] & 1 else tree[2]
        return tree

    def margin(self, code: int) -> float:
        return self.bias + sum(self._value(t, code) for t in self.trees)

    @classmethod
    def fit(cls, counts: list[tuple[int, int, int]], held: list[tuple[int, int, int]] | None = None, precision: float = PRECISION) -> BoostedTrees:
        """From (code, candidates, positives); thresholds from ``held``, the like of other documents, where a kind has enough of it."""
        if sum(n for _, n, _ in held or []) < LEAST_HELD * len(KINDS):  # too few to hold any out
            counts, held = [*counts, *(held or [])], None
        counts = sorted(counts)
        total, positive = sum(n for _, n, _ in counts), sum(p for _, _, p in counts)
        model = cls(math.log((positive + 0.5) / (total - positive + 0.5)), [])
        if not total:
            return model
        margins = [model.bias] * len(counts)
        for _ in range(ROUNDS):
            rows = []
            for (code, n, p), m in zip(counts, margins):
                q = 1 / (1 + math.exp(-m))
                rows.append((code, n, p - n * q, n * q * (1 - q)))
            tree = cls._grow(rows, DEPTH)
            model.trees.append(tree)
            margins = [m + cls._value(tree, code) for m, (code, _, _) in zip(margins, counts)]
        for kind in range(len(KINDS)):
            part = [x for x in held or [] if x[0] >> len(BITS) == kind]
            if sum(n for _, n, _ in part) < LEAST_HELD:
                part = [x for x in [*counts, *(held or [])] if x[0] >> len(BITS) == kind]
            model._calibrate(kind, part, precision)
        return model

    def _calibrate(self, kind: int, part: list[tuple[int, int, int]], precision: float) -> None:
        """The kind's lowest score at which everything from it on is still precise and likelier right than wrong."""
        by_score: dict[float, list[int]] = {}
        for code, n, p in part:
            both = by_score.setdefault(round(self.margin(code), 9), [0, 0])
            both[0], both[1] = both[0] + n, both[1] + p
        taken = right = 0
        for m, (n, p) in sorted(by_score.items(), reverse=True):
            taken, right = taken + n, right + p
            if m <= 0 or right < precision * taken or p < precision * n:
                break
            self.thresholds[kind] = m

    def sql(self, code: str) -> str:
        def case(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{tree!r}D"
            return f"CASE WHEN ({code} & {1 << tree[0]}) <> 0 THEN {case(tree[1])} ELSE {case(tree[2])} END"

        return " + ".join([f"{self.bias!r}D", *map(case, self.trees)])


def fit_trees(spans: DataFrame) -> BoostedTrees:
    fold = F.pmod(F.xxhash64("row"), F.lit(FOLDS)) == 0
    counts = spans.where("y is not null").groupBy("code", fold.alias("held")).agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("p")).collect()
    return BoostedTrees.fit(*([(r["code"], r["n"], r["p"]) for r in counts if r["held"] == held] for held in (False, True)))


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", work: Workspace | None = None) -> DataFrame:
    """(id, base, spans): arrays of (kind, s, e), kinds numbered as in KINDS, in order; ``spans`` has the base and what the trees add."""
    work = work or Workspace(df.sparkSession, "pii")
    spans = work.keep(find_spans(work.keep(find_matches(df, id_col, text_col), "matches")), "spans")
    work.drop("matches")
    trees = fit_trees(spans)
    least = " ".join(f"WHEN {k} THEN {t - 1e-6!r}D" for k, t in sorted(trees.thresholds.items()))
    added = f"NOT base AND NOT meets AND ({trees.sql('code')}) >= CASE kind {least} END" if least else "false"
    span = F.struct("kind", "s", "e")
    rows = spans.withColumn("added", F.coalesce(F.expr(added), F.lit(False)))
    return rows.groupBy("row").agg(
        F.first("id").alias("id"), F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("base") | F.col("added"), span))).alias("spans"),
    ).drop("row")


def redact(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    joined = df.select(F.col(id_col).cast("long").alias("id"), no_null(text_col).alias("text")).join(spans.select("id", "spans"), "id", "left")
    ordered = joined.withColumn("o", F.expr("array_sort(transform(coalesce(spans, array()), x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind)))"))
    text = f"""aggregate(o, named_struct('at', 0, 'out', ''), (a, x) -> CASE WHEN x.e <= a.at THEN a ELSE named_struct('at', x.e,
        'out', CASE WHEN x.s < a.at THEN a.out ELSE concat(a.out, substring(text, a.at + 1, x.s - a.at), {names}[x.kind]) END) END,
        a -> concat(a.out, substring(text, a.at + 1)))"""
    return ordered.select("id", F.expr(text).alias("text"))


def joined_spans(column: str):
    """kind:start:end, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({column}, x -> concat_ws(':', {names}[x.kind], x.s, x.e)), ',')")
