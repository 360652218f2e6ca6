"""Secrets in texts: known forms, and strings that pass a battery of randomness tests.

Matches of each pattern are cut out of the text together with the gaps between
them; lengths of gaps and matches, added up per row in order, give the places.

A long unbroken string that lies outside the known forms is a candidate.  Its
characters tell its encoding (the smallest alphabet that writes it), and three
tests ask whether its characters were drawn evenly and independently from that
alphabet: chi-squared against uniform counts, runs of equal character classes,
and serial correlation of neighbours.  The tests' two-sided p-values are joined
by Fisher's method; what they reject is not random.

That a short string passes proves little.  So each candidate also gets the
probability that ordinary text of its length and encoding looks as random: under
ordinary text chi-squared is noncentral, growing with the length by the index of
coincidence, and runs have another mean.  Over these probabilities the rate of
false discoveries is held (Benjamini and Hochberg) in each class of encoding and
length, over all candidates of the table.  Tail probabilities are counted in
steps of their logarithm, so what is gathered has a bounded size.

Everything is made of DataFrame and SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm.common import checkpointed

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# Runs of the full length at least: the same matches as of any length, cut to those.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")
RANDOM = KINDS.index("random")
LEAST_VALUE = 8

LETTERS = 26
# Name, characters, sizes of the classes that runs are counted of, and the share
# of neighbours of different class in ordinary text.
ENCODINGS = (
    ("hex", "([0-9a-f]+|[0-9A-F]+)", (10, 6), 0.25),
    ("letters", "([a-z]+|[A-Z]+)", (5, 21), 0.60),  # vowels and others
    ("base32", "[A-Z2-7]+", (LETTERS, 6), 0.10),
    ("base36", "([a-z0-9]+|[A-Z0-9]+)", (LETTERS, 10), 0.15),
    ("mixed letters", "[A-Za-z]+", (LETTERS, LETTERS), 0.25),
    ("base62", "[A-Za-z0-9]+", (LETTERS, LETTERS, 10), 0.25),
    ("base64", ".*", (LETTERS, LETTERS, 10, 2), 0.30),
)
SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-"
COINCIDENCE = 0.0667  # of two letters of English text
HEX_COINCIDENCE = 0.1  # padded and repeated digits
REJECTED = 0.001  # joined p-value below which a string is not random
FALSE_SHARE = 0.01  # of what is reported, at most, if ordinary text is as assumed
STEPS, DEEPEST = 20, 1200  # steps per unit of the logarithm, and the last one
FAR = 20  # normal values beyond it count as it
PIECE = 4096  # characters taken apart at a time


def matches(text: Column, pattern: str, kind: int) -> Column:
    """The leftmost non-overlapping matches, each with the length of the gap before it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.when(F.size(found) > 0, F.split(text, pattern, -1))
    return F.transform(
        found,
        lambda match, k: F.struct(
            F.lit(kind).alias("kind"),
            k.alias("pos"),
            F.length(F.element_at(gaps, k + 1)).alias("gap"),
            match.alias("match"),
        ),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """``(row, kind, start, end, match)`` per match, in code points."""
    one = rows.select("row", F.explode("found").alias("m")).select("row", "m.*")
    before = W.partitionBy("row", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(before)
    return one.select("row", "kind", "match", end.alias("end")).selectExpr(
        "row", "kind", "end - length(match) AS start", "end", "match"
    )


def _outside(spans: DataFrame) -> DataFrame:
    """Candidates that no span of a known form touches."""
    known = F.col("kind") != RANDOM
    order = W.partitionBy("row").orderBy("start", "kind")
    earlier = F.max(F.when(known, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    later = F.min(F.when(known, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing))
    marked = spans.withColumns({"__earlier": earlier, "__later": later})
    free = "kind = {} AND coalesce(__earlier <= start, true) AND coalesce(__later >= end, true)"
    return marked.filter(free.format(RANDOM)).drop("__earlier", "__later")


def _tail(z: str) -> str:
    """Probability of a normal value above ``z``, by a logistic curve (within 0.0002)."""
    return f"(1 / (1 + exp(1.5976 * ({z}) + 0.07056 * pow({z}, 3))))"


def _by_encoding(values) -> str:
    """The value for each row's encoding."""
    return "CASE encoding " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


def _tested(candidates: DataFrame) -> DataFrame:
    """Add ``encoding``, the p-values of the battery and ``ordinary``, that of ordinary text.

    A string of digits alone has no encoding and is left out.
    """
    sizes = [sum(classes) for _, _, classes, _ in ENCODINGS]
    differ = [1 - sum((c / n) ** 2 for c in classes) for n, (_, _, classes, _) in zip(sizes, ENCODINGS)]
    usual = [share for *_, share in ENCODINGS]
    extra = [n * (HEX_COINCIDENCE if name == "hex" else COINCIDENCE) - 1 for n, (name, *_) in zip(sizes, ENCODINGS)]
    encoding = " ".join(f"WHEN match RLIKE '^{form}$' THEN {k}" for k, (_, form, *_) in enumerate(ENCODINGS))
    symbols = F.array(*[F.lit(c) for c in SYMBOLS])
    n = F.length("match")
    counts = F.transform(symbols, lambda c: (n - F.length(F.replace(F.col("match"), c, F.lit("")))).cast("double"))
    squares = F.aggregate(counts, F.lit(0.0), lambda total, c: total + c * c)
    runs = (
        "CASE WHEN encoding = 1 THEN size(regexp_extract_all(match, '[aeiouAEIOU]+|[^aeiouAEIOU]+', 0)) "
        "ELSE size(regexp_extract_all(match, '[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+', 0)) END"
    )
    pieces = F.regexp_extract_all("match", F.lit(f".{{1,{PIECE}}}"), F.lit(0))
    codes = F.transform(pieces, lambda piece: F.transform(F.split(piece, ""), lambda c: F.ascii(c).cast("double")))
    # Sums over neighbours within pieces: how many, of both, of squares, of products.
    pair_sums = F.transform(
        codes,
        lambda x: F.aggregate(
            F.zip_with(
                F.slice(x, 1, F.size(x) - 1),
                F.slice(x, 2, F.size(x) - 1),
                lambda a, b: F.struct((a + b).alias("s"), (a * a + b * b).alias("q"), (a * b).alias("p")),
            ),
            F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("p")),
            lambda t, x: F.struct(
                (t.n + 1).alias("n"), (t.s + x.s).alias("s"), (t.q + x.q).alias("q"), (t.p + x.p).alias("p")
            ),
        ),
    )
    pairs = F.aggregate(
        pair_sums,
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("p")),
        lambda t, x: F.struct(
            (t.n + x.n).alias("n"), (t.s + x.s).alias("s"), (t.q + x.q).alias("q"), (t.p + x.p).alias("p")
        ),
    )
    steps = (
        {"encoding": F.expr(f"CASE WHEN match RLIKE '^[0-9]+$' THEN NULL {encoding} END")},
        {
            "n": n.cast("double"),
            "squares": squares,
            "changes": F.expr(f"double({runs}) - 1"),
            "pairs": pairs,
            "k": F.expr(f"double({_by_encoding(sizes)})"),
            "differ": F.expr(f"double({_by_encoding(differ)})"),
            "usual": F.expr(f"double({_by_encoding(usual)})"),
            "extra": F.expr(f"double({_by_encoding(extra)})"),
        },
        {
            "chi": F.expr("k * squares / n - n"),
            "free": F.expr("k - 1"),
            "drift": F.expr("(n - 1) * extra"),
            # Pearson's correlation of neighbours; equal characters throughout correlate fully.
            "serial": F.expr(
                "coalesce(try_divide(pairs.p / pairs.n - pow(pairs.s / (2 * pairs.n), 2),"
                " pairs.q / (2 * pairs.n) - pow(pairs.s / (2 * pairs.n), 2)), 1D)"
            ),
        },
        {
            "z_chi": F.expr("(chi - free) / sqrt(2 * free)"),
            "z_runs": F.expr("(changes - (n - 1) * differ) / sqrt((n - 1) * differ * (1 - differ))"),
            "z_serial": F.expr("(serial + 1 / n) * sqrt(n)"),
            # How much more random than ordinary text, by chi-squared and by runs.
            "o_chi": F.expr("(free + drift - chi) / sqrt(2 * (free + 2 * drift))"),
            "o_runs": F.expr(
                "sign(differ - usual) * (changes - (n - 1) * usual) / sqrt((n - 1) * usual * (1 - usual))"
            ),
        },
        {
            f"p_{name}": F.expr(f"least(2 * {_tail(f'least(abs(z_{name}), {FAR})')}, 1)")
            for name in ("chi", "runs", "serial")
        },
        {"half": F.expr("-ln(p_chi) - ln(p_runs) - ln(p_serial)")},
        {
            "battery": F.expr("exp(-half) * (1 + half + half * half / 2)"),
            "ordinary": F.expr(_tail(f"least(greatest((o_chi + o_runs) / sqrt(2), -{FAR}), {FAR})")),
        },
    )
    found = candidates
    for step in steps:
        found = found.withColumns(step)
        if "encoding" in step:
            found = found.filter("encoding IS NOT NULL")
    return found


def _graded(tested: DataFrame) -> DataFrame:
    """Add the class of encoding and length, and the step of the p-value; rejected ones have step 0."""
    return tested.selectExpr(
        "row", "start", "end",
        "encoding * 64 + int(floor(2 * log2(n))) AS class",
        f"CASE WHEN battery < {REJECTED} THEN 0 "
        f"ELSE int(least(floor(-ln(ordinary) * {STEPS}), {DEEPEST})) END AS step",
    )


def least_steps(graded: DataFrame, share: float = FALSE_SHARE) -> dict[int, int]:
    """Per class the step from which on candidates are discoveries.

    A step holds p-values up to ``exp(-step / STEPS)``.  It is the lowest one at which
    that bound times all candidates of the class is at most ``share`` of those found.
    There are at most a few hundred classes of ``DEEPEST`` steps.
    """
    counts = graded.groupBy("class", "step").count()
    deeper = W.partitionBy("class").orderBy(F.desc("step"))
    whole = W.partitionBy("class")
    held = counts.select(
        "class",
        "step",
        F.sum("count").over(deeper).alias("found"),
        F.sum("count").over(whole).alias("all"),
    ).filter(f"step > 0 AND exp(-step / double({STEPS})) * all <= {share} * found")
    return {r["class"]: r["step"] for r in held.groupBy("class").agg(F.min("step").alias("step")).collect()}


def _random(graded: DataFrame) -> DataFrame:
    found = [f"class = {one} AND step >= {least}" for one, least in sorted(least_steps(graded).items())]
    return graded.filter(" OR ".join(found) or "false").select(
        "row", F.lit(RANDOM).alias("kind"), "start", "end"
    )


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id and ``spans``, an array of ``(start, kind, end)`` in order.

    Places are code points, the end exclusive; ``kind`` numbers ``KINDS``.  Known
    forms: values assigned to telling names (the value has 8 characters or more),
    access key ids of 16 characters or more, 32 or more hexadecimal digits.  They may
    overlap each other.  Random strings are reported where no known form is.
    A NULL text is an empty one and has no spans; NULL ids and rows that repeat stay,
    each with its own spans; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    rows = checkpointed(
        docs.select(
            F.col(key).alias("id"),
            F.concat(*[matches(body, pattern, kind) for kind, pattern in enumerate(patterns)]).alias("found"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    value = F.length(F.regexp_extract("match", ASSIGN, 2))
    spans = _placed(rows.filter("size(found) > 0")).filter(
        (F.col("kind") != KINDS.index("assign")) | (value >= LEAST_VALUE)
    )
    spans = checkpointed(spans)
    known = spans.filter(F.col("kind") != RANDOM).select("row", "kind", "start", "end")
    graded = checkpointed(_graded(_tested(_outside(spans))))
    every = known.unionByName(_random(graded))
    listed = every.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    none = F.from_json(F.lit("[]"), "array<struct<start: bigint, kind: int, end: bigint>>")
    return (
        rows.select("id", "row")
        .join(listed, "row", "left")
        .select(F.col("id").alias(key), F.coalesce("spans", none).alias("spans"))
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(name) for name in KINDS])
    one = lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
