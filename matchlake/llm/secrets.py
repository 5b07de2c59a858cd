"""Secret scan (DataFrame functions only).

Base spans: three patterns, leftmost and non-overlapping for each kind.
Positions come from the pieces between the matches: ``split`` and
``regexp_extract_all`` walk a text alike, so a match starts behind all pieces
and matches before it.  Texts are read once; what follows works on a narrow
table of lengths (doc, kind, place, piece length, match length).

The method adds ``entropy`` spans.  Candidates are maximal runs of 24 or more
characters [A-Za-z0-9+/_-] (with up to two ``=``).  For each character class
(hex digits of one case; base64 letters and digits) a window slides over the
candidate; the counts of its characters are kept incrementally, and with them
the sum of c*log2(c), so that each step costs the change of two counts:
H = log2(W) - sum / W.  A window counts while it lies in one run of its class
and touches no match of an allow-list rule; two more counts, kept in the same
way, say so.  A candidate with a window of its class's entropy is a span, unless
it overlaps a base span (which always stays).  Identifiers reach the lower
base64 entropy too, so below ``LETTERS`` a window needs two groups of digits.

Defined results: a null or empty text has no spans; repeated rows get a row
each; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import stored

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"      # AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"             # [0-9a-f]+ of 32 or more characters
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGNED = 8

CANDIDATE = r"[A-Za-z0-9+/_-]{24,}={0,2}"
WINDOW = 24
# class -> (its alphabet, least entropy in bits of a window with two groups of digits, and of any window)
LETTERS = 4.15
CLASSES = {"hex": ("0-9a-f", 3.0, 9.9), "HEX": ("0-9A-F", 3.0, 9.9), "base64": ("A-Za-z0-9+/", 3.9, LETTERS)}

# What looks random and is not secret: sample keys and placeholders (with what is written on to them), UUIDs,
# alphabets, paths, numbers.
ALLOW = (
    r"(?i)(example|sample|dummy|placeholder|changeme|your[_-])[a-z0-9+/]*",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)0123456789|abcdefgh|(.)\1{7}",
    r"(/[a-z]{3,}){2}",
    r"^[0-9/_+-]+$",
)


def _lengths(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<kind, at, gap, len, ok, value>> of the matches; ``gap``: code points since the last match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    assigned = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else hits
    wanted = kind == 3

    def one(hit: Column, i: Column) -> Column:
        ok = F.length(F.get(assigned, i)) >= MIN_ASSIGNED if kind == 0 else F.lit(True)
        return F.struct(F.lit(kind).alias("kind"), i.alias("at"), F.length(F.get(gaps, i)).alias("gap"),
                        F.length(hit).alias("len"), ok.alias("ok"),
                        (hit if wanted else F.lit(None).cast("string")).alias("value"))
    return F.when(text.rlike(pattern), F.transform(hits, one))


def _characters(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(value, i, F.lit(1)))


def _slide(value: Column, window: int, zero: Column, keep, blocked: Column | None = None, marks: Column | None = None) -> Column:
    """Slides a window over the value; ``keep(best, entropy, marks in the
    window)`` is folded over the windows without a blocked character."""
    chars = _characters(value)

    def xlogx(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    nothing = F.transform(chars, lambda _: F.lit(0))
    base = F.struct(chars.alias("chars"), F.array_distinct(chars).alias("letters"),
                    (nothing if blocked is None else blocked).alias("blocked"), (nothing if marks is None else marks).alias("marks"))
    # bind the arrays once: transform over a one-element array
    placed = F.transform(F.array(base), lambda x: F.struct(
        F.transform(x["chars"], lambda c: F.array_position(x["letters"], c).cast("int") - 1).alias("place"),
        F.size(x["letters"]).alias("size"), x["blocked"].alias("blocked"), x["marks"].alias("marks")))

    def run(x: Column) -> Column:
        def slide(acc: Column, i: Column) -> Column:
            come = F.get(x["place"], i)
            gone = F.when(i >= window, F.get(x["place"], i - window)).otherwise(F.lit(-1))
            c_in = F.get(acc["n"], come).cast("double")
            c_out = F.get(acc["n"], F.greatest(gone, F.lit(0))).cast("double")
            change = F.when(come == gone, F.lit(0.0)).otherwise(
                xlogx(c_in + 1) - xlogx(c_in) + F.when(gone >= 0, xlogx(c_out - 1) - xlogx(c_out)).otherwise(F.lit(0.0)))
            n = F.transform(acc["n"], lambda c, k: (c + F.when(k == come, 1).otherwise(0)
                                                    - F.when(k == gone, 1).otherwise(0)).cast("int"))
            s = acc["s"] + change

            def counted(name: str, back: int) -> Column:
                left = F.when(i >= back, F.get(x[name], i - back)).otherwise(F.lit(0))
                return (acc[name] + F.get(x[name], i) - left).cast("int")
            # a mark belongs to a character and the one before it, so the first of a window has none
            off, on = counted("blocked", window), counted("marks", window - 1)
            h = F.log2(F.lit(float(window))) - s / window
            full = (i >= window - 1) & (off == 0)
            return F.struct(n.alias("n"), s.alias("s"), off.alias("blocked"), on.alias("marks"),
                            F.when(full, keep(acc["best"], h, on)).otherwise(acc["best"]).alias("best"))

        start = F.struct(F.transform(F.sequence(F.lit(1), x["size"]), lambda _: F.lit(0)).alias("n"), F.lit(0.0).alias("s"),
                         F.lit(0).alias("blocked"), F.lit(0).alias("marks"), zero.alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(x["place"]) - 1), start, slide, lambda acc: acc["best"])

    return F.get(F.transform(placed, run), F.lit(0))


def window_entropy(value: Column, window: int) -> Column:
    """Highest Shannon entropy (bits per character) of any ``window`` consecutive characters."""
    return _slide(value, window, F.lit(0.0), lambda best, h, _: F.greatest(best, h))


def _covered(value: Column, pattern: str) -> Column:
    """Which characters lie in a match of the pattern: array of 0 and 1."""
    hits = F.regexp_extract_all(value, F.lit(pattern), F.lit(0))
    lengths = F.transform(hits, lambda h: F.length(h))
    return F.flatten(F.transform(F.split(value, pattern, -1), lambda gap, i: F.concat(
        F.array_repeat(F.lit(0), F.length(gap)), F.array_repeat(F.lit(1), F.coalesce(F.get(lengths, i), F.lit(0))))))


def is_random(value: Column, allow: tuple[str, ...] = ALLOW, window: int = WINDOW) -> Column:
    """Whether some window of a class reaches its entropy outside what the allow-list covers."""
    found = F.lit(False)
    rules = F.transform(_characters(value), lambda _: F.lit(0))
    for pattern in allow:
        rules = F.when(value.rlike(pattern), F.zip_with(rules, _covered(value, pattern), lambda a, b: F.greatest(a, b))).otherwise(rules)
    digit = F.transform(_characters(value), lambda c: c.rlike("[0-9]"))
    groups = F.transform(digit, lambda d, i: F.when((i > 0) & d & ~F.get(digit, i - 1), 1).otherwise(0))
    for alphabet, least, alone in CLASSES.values():
        outside = F.transform(_characters(value), lambda c: F.when(c.rlike(f"[{alphabet}]"), 0).otherwise(1))
        blocked = F.zip_with(rules, outside, lambda a, b: F.greatest(a, b))
        enough = lambda best, h, marks: best | (h >= alone) | ((h >= least) & (marks >= 2))  # noqa: B023, E731
        run = value.rlike(f"[{alphabet}]{{{window},}}")
        found = found | F.when(run, _slide(value, window, F.lit(False), enough, blocked, groups)).otherwise(False)
    return found


def secret_spans(docs: DataFrame, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_entropy,
    base (array of kind:start:end), all (the same with entropy spans)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = stored(docs.select(
        F.col("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.concat(*[F.coalesce(_lengths(text, p, k), F.array()) for k, p in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE))])
         .alias("found")), "matches")
    each = found.filter(F.size("found") > 0).select("row", F.inline("found"))
    upto = Window.partitionBy("row", "kind").orderBy("at")      # the matches of one text
    spans = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).filter("ok").select(
        "row", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "value")
    kind3 = F.col("kind") == 3
    # a word of one case without digits is no key
    spans = spans.filter(~kind3 | (F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z]")))
    spans = spans.filter(F.when(kind3, is_random(F.col("value"), allow)).otherwise(True)).drop("value")
    # entropy spans that overlap a base span add nothing: running ends of the base spans on either side
    base_end = F.when(~kind3, F.col("end"))
    base_start = F.when(~kind3, F.col("start"))
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    spans = (spans.withColumn("_be", F.max(base_end).over(before)).withColumn("_bs", F.min(base_start).over(after))
             .filter(~(kind3 & (F.coalesce(F.col("_be") > F.col("start"), F.lit(False))
                                | F.coalesce(F.col("_bs") < F.col("end"), F.lit(False))))))
    grouped = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(s: Column) -> Column:
        return F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))

    def number(kind: int) -> Column:
        return F.coalesce(F.size(F.filter("spans", lambda s: s["kind"] == kind)), F.lit(0)).cast("bigint")

    joined = found.select("doc_id", "row").join(grouped, "row", "left")
    spans_or_none = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    return joined.withColumn("spans", spans_or_none).select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        number(3).alias("n_entropy"),
        F.transform(F.filter("spans", lambda s: s["kind"] < 3), written).alias("base"),
        F.transform("spans", written).alias("all"))
