"""Chat conversations as training texts of limited size.

Prefix sums of the turns' tokens cut a conversation at turn borders.  The room
of a window is the budget less the system turn and less the history.  Windows
are cut one after the other, each as full as the room allows, within stretches
of 64 rooms; stretches are cut without regard to each other, so a conversation
of any length is cut in parallel and at most one window in 64 ends early.  A
turn longer than the room goes in parts that each fill a room, so no window is
longer than the budget and each has something new.

Each window repeats the system turn and the turns that lie within ``history``
tokens before it.  Repeated turns are masked: each assistant turn is under the
loss once, where it is new.

Template: ``<turn role>\\n`` text ``</turn>\\n``.  A turn in parts ends each but
the last with ``</part>`` and begins each but the first with ``<part role>``.  In
roles and texts a backslash becomes ``\\s``, ``<`` becomes ``\\l`` and ``>`` becomes
``\\g``, so only the template writes ``<`` and every text reads back as it was.
Tokens are those of the formatted text; an escape is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.ordered import running_total
from folioscope.llm.common import checkpointed

TOKEN = r"\\[slg]|\p{L}+|\p{N}+|[^\s\p{L}\p{N}\\]+"
# The same token after blanks, without a way back into it.
STEP = r"(?:\s*+(?:\\[slg]|\p{L}++|\p{N}++|[^\s\p{L}\p{N}\\]++))"
MARKS = 6  # tokens of a turn's template, the role not counted
BUDGET = 1024
HISTORY = 256
CHUNK = 64  # turns per chunk of the prefix sums
STRETCH = 64  # rooms per stretch of windows
TURN, PART, HEAD = "<turn ", "<part ", ">\n"
LAST, MORE = "</turn>\n", "</part>\n"
KEYS = ["absent", "conv"]


def escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\s"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in ((">", "\\g"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Escaped rows; ``place`` orders the turns of a conversation, NULL turns first."""
    raw, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    said = rows.select(
        F.col(conv).isNull().alias("absent"),
        F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("conv"),
        F.struct(
            F.coalesce(F.col(turn).cast("long"), F.lit(-(2**63))).alias("turn"),
            who.alias("role"),
            F.xxhash64(raw).alias("text"),
        ).alias("place"),
        escaped(who).alias("role"),
        escaped(raw).alias("text"),
    )
    return said.select(
        "*",
        (F.regexp_count("role", F.lit(TOKEN)) + MARKS).cast("long").alias("marks"),
        F.regexp_count("text", F.lit(TOKEN)).cast("long").alias("words"),
    )


def _in_parts(turns: DataFrame) -> DataFrame:
    """A row per part; a turn that fits the room is one part."""
    pattern = F.concat(F.lit(rf"\G({STEP}{{"), F.col("step"), F.lit(r"}+)(?=\s*+\S)"))
    parts = F.split(F.regexp_replace(F.col("text"), pattern, F.lit("$1<")), "<")
    pieces = F.when(F.col("parts") > 1, parts).otherwise(F.array("text"))
    return turns.select(
        *KEYS, "role", "leads", "room", "parts", "since", "until", "marks", "step",
        F.posexplode(pieces).alias("part", "text"),
    ).selectExpr(
        *KEYS, "role", "text", "leads", "room",
        "part = 0 AS opens",
        "part = parts - 1 AS closes",
        "since + part * (step + marks) AS since",
        "least(until, since + (part + 1) * (step + marks)) AS until",
    )


def _starts(parts: DataFrame, budget: int) -> DataFrame:
    """Where the windows of each stretch begin: at its first part, then at each part that does
    not fit.  A conversation's first window repeats nothing and may fill the budget."""
    # A stretch is 64 rooms long and each part takes a template's tokens: its list is bounded.
    sized = parts.groupBy(*KEYS, "stretch", "room").agg(
        F.sort_array(F.collect_list(F.struct("until", "since"))).alias("ends")
    )
    cuts = (
        "aggregate(ends, named_struct('at', ends[0].since, 'all', array(ends[0].since)), (s, x) ->"
        f" IF(x.until <= s.at + IF(s.at = 0, {budget}L, room), s,"
        " IF(x.since = s.at, s, named_struct('at', x.since, 'all', array_append(s.all, x.since)))), s -> s.all)"
    )
    return sized.selectExpr(*KEYS, "stretch", "room", f"{cuts} AS starts")


def windows(
    rows: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv_id, window, repeated, formatted, loss)`` per window.

    ``window`` orders the windows of a conversation, ``repeated`` counts the
    leading turns repeated from earlier, ``loss`` lists ``(start, length)`` in
    code points of ``formatted``.  A system turn is the conversation's first
    turn with the role ``system``, if it takes half of the budget without
    history at most; a longer or later one is an ordinary turn.  A window is
    longer than the budget only if a role alone is.  NULL texts
    and roles count as empty, rows with a NULL ``conv_id`` as one conversation.
    Rows of the same turn are ordered by role and text; whole rows repeated are
    turns of their own.  An empty table gives an empty result.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be shorter than the budget")
    fresh = budget - history
    turns = _turns(rows, conv, turn, role, text)
    size = F.col("marks") + F.col("words")
    first = turns.groupBy(*KEYS).agg(F.min(F.struct("place", "text", size.alias("tokens"))).alias("first"))
    system = first.filter(f"first.place.role = 'system' AND first.tokens * 2 <= {fresh}")
    sized = (
        turns.join(system, KEYS, "left")
        .withColumn("room", F.expr(f"{fresh} - coalesce(first.tokens, 0)"))
        .withColumn("step", F.expr("greatest(room - marks, 1)"))
        .withColumn("parts", F.expr("greatest((words + step - 1) DIV step, 1)"))
        .withColumn("tokens", F.expr("words + parts * marks"))
        .withColumn("leads", F.expr("place <=> first.place"))
        .drop("first", "words")
    )
    chunk = F.floor(F.col("place.turn") / CHUNK)
    summed = running_total(sized, KEYS, "place", chunk, "tokens", "until", apart=True)
    parts = _in_parts(summed.withColumn("since", F.col("until") - F.col("tokens")))
    cut = checkpointed(parts.withColumn("stretch", F.expr(f"since DIV (room * {STRETCH})")))
    starts = _starts(cut, budget)
    span = [*KEYS, "window"]
    item = "struct({kind} AS kind, until, role, text, opens, closes) AS item"
    new = (
        cut.join(starts.drop("room"), [*KEYS, "stretch"])
        .withColumn("window", F.expr("array_max(filter(starts, s -> s <= since))"))
        .selectExpr(*span, item.format(kind=2))
    )
    # The first window has the system turn as a new one, and nothing before it.
    later = starts.selectExpr(*KEYS, "room", "explode(starts) AS window").filter("window > 0")
    back = cut.filter(f"NOT (leads AND since = 0) AND until - since <= {history}").selectExpr(
        *KEYS, "role", "text", "opens", "closes", "since", "until",
        f"explode(sequence(until DIV room, (since + {history}) DIV room)) AS cell",
    )
    before = (
        later.withColumn("cell", F.expr("window DIV room"))
        .join(back, [*KEYS, "cell"])
        .filter(f"until <= window AND window <= since + {history}")
        .selectExpr(*span, item.format(kind=1))
    )
    again = (
        later.join(system, KEYS)
        .selectExpr(*span, "0L AS until", "'system' AS role", "first.text AS text", "true AS opens", "true AS closes")
        .selectExpr(*span, item.format(kind=0))
    )
    gathered = (
        new.union(before).union(again).groupBy(*span).agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    heads = F.transform(
        "items",
        lambda x: F.concat(F.when(x["opens"], TURN).otherwise(PART), x["role"], F.lit(HEAD)),
    )
    bodies = F.transform("items", lambda x: x["text"])
    tails = F.transform("items", lambda x: F.when(x["closes"], LAST).otherwise(MORE))
    laid = gathered.withColumns({"heads": heads, "bodies": bodies, "tails": tails}).withColumns(
        {
            "turns": F.transform(
                F.arrays_zip("heads", "bodies", "tails"),
                lambda x: F.concat(x["heads"], x["bodies"], x["tails"]),
            ),
            "repeated": F.size(F.filter("items", lambda x: x["kind"] < 2)),
        }
    )
    places = F.transform(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda k: F.struct(
            (
                F.aggregate(F.slice("turns", 1, k), F.lit(0), lambda n, t: n + F.length(t))
                + F.length(F.get("heads", k))
            ).alias("start"),
            F.length(F.get("bodies", k)).alias("length"),
            ((F.get("items", k)["kind"] == 2) & (F.get("items", k)["role"] == "assistant")).alias("learn"),
        ),
    )
    loss = F.transform(
        F.filter(places, lambda x: x["learn"]),
        lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")),
    )
    return laid.select(
        F.expr("CASE WHEN NOT absent THEN conv END").alias(conv),
        "window",
        "repeated",
        F.array_join("turns", "").alias("formatted"),
        loss.alias("loss"),
    )


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What each conversation says, from its formatted windows alone.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.
    A digest needs the conversation's text as one value.
    """
    begins = "<(?=turn |part )"
    parts = F.slice(F.split("formatted", begins), F.col("repeated") + 2, F.size(F.split("formatted", begins)))
    head, tail = len(TURN) - 1, len(LAST)

    def opens(part: Column) -> Column:
        return F.startswith(part, F.lit(TURN[1:]))

    def spoken(part: Column) -> Column:
        role = F.substring_index(F.substring(part, F.lit(head + 1), F.length(part)), ">", 1)
        begin = F.length(role) + head + len(HEAD)
        text = F.substring(part, begin + 1, F.length(part) - begin - tail)
        return F.concat(
            F.when(opens(part), F.concat(unescaped(role), F.lit("\n"))).otherwise(""),
            unescaped(text),
            F.when(F.endswith(part, F.lit(LAST)), "\n").otherwise(""),
        )

    under = F.transform(
        "loss", lambda x: unescaped(F.substring(F.col("formatted"), x["start"] + 1, x["length"]))
    )
    read = formatted.withColumn("parts", parts).select(
        conv,
        "window",
        F.size(F.filter("parts", opens)).alias("n"),
        F.array_join(F.transform("parts", spoken), "").alias("said"),
        F.array_join(under, "").alias("learned"),
        F.length("formatted").alias("chars"),
    )
    joined = read.groupBy(conv).agg(
        F.sort_array(F.collect_list(F.struct("window", "said", "learned"))).alias("all"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    learned = F.array_join("all.learned", "")
    return joined.select(
        conv,
        "n_turns",
        F.sha2(F.array_join("all.said", ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
