"""Toxicity from a weighted finite-state grammar over clauses.

Words become classes (insult, violence, person, negation, speech, intent), and a
cascade of transducers reads the classes of a clause: each rewrites them and
passes weights on to the next.

* insult: a hostile word is an insult of the weight learned for its stem;
* target: an insult near a person, before or after it, counts more;
* threat: violence and soon after it a person is a threat, if intent leads to it or
  nobody is said to do it; violence that somebody is told to have done is none;
* negation: an insult or a threat soon after a negation counts less;
* reported speech: what follows a verb of speech, or stands in quotes, counts less.

A clause ends with a full stop or the like.  A comma or a colon inside it ends what
target, threat and negation were waiting for, while speech goes on: what follows
"she said," is still reported.  The machines read a clause as a stream, each in
one state, so a clause may be of any length.

What is scored is the matched clause, not the word.  Stems of hostile words come
from labelled training texts (words and beginnings of words that mark toxic
texts) besides a short fixed list; a logistic regression on sums over clauses
gives the score.  Both are fitted on ``FIT_ROWS`` rows at most, chosen by hash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioscope.llm.common import SHORT, checkpointed

FIT_ROWS = 20_000
FIT_PARTS = 32  # tasks that learn from them
STEMS = 4_000  # learned stems at most: the strongest
LEAST_DOCS = 3
LEAST_ODDS = 8.0
PREFIXES = range(3, 10)
DOCS_AT_ONCE = 500
FEATURES = 5

# Fixed words.
INSULTS = (
    "asshole bastard clown cretin degenerate disgusting dumb dunce fool idiot imbecile loser lowlife "
    "moron parasite pathetic pig scum stupid trash vermin worthless "
    "arschloch dummkopf idiotisch abschaum versager connard imbécile ordure crétin idiota estúpido "
    "imbécil basura escoria"
).split()
VIOLENCE = (
    "kill murder stab shoot strangle beat burn hang slaughter umbringen töten erschießen tuer égorger "
    "matar apuñalar"
).split()
PERSONS = (
    "you your yours he she they them him her people everyone du dich dein ihr sie tu toi ton vous votre "
    "ils tú usted ustedes ellos"
).split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't nicht kein keine nie pas jamais nunca".split()
SPEECH = (
    "said says say called quoted reported claimed wrote tweeted sagte schrieb dit écrit dijo escribió"
).split()
INTENT = "will shall gonna going must should werde will vais voy".split()

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”«»,:]")
CLAUSE_END = re.compile(r"[.!?;\n|]")

Symbols = Iterable[tuple[str, float]]


@dataclass
class Transducer:
    """A deterministic finite-state machine over classes.

    ``moves[state, class]`` is ``(next state, class written, factor of the weight, weight
    added)``; where there is none, ``(state, ANY)`` holds, and else the symbol passes unchanged.
    """

    moves: dict[tuple[str, str], tuple[str, str | None, float, float]] = field(default_factory=dict)

    def read(self, symbols: Symbols) -> Iterator[tuple[str, float]]:
        state, moves = "start", self.moves
        for name, weight in symbols:
            move = moves.get((state, name)) or moves.get((state, "ANY"))
            if move is None:
                yield name, weight
                continue
            state, out, factor, added = move
            yield out or name, weight * factor + added

    def waits(self, state: str, words: int, hits: dict[str, tuple[str, float, float]], over: str = "start"):
        """From ``state`` on, for so many further words, ``hits`` are rewritten; then comes ``over``."""
        for k in range(words, 0, -1):
            here = state if k == words else f"{state}{k}"
            after = f"{state}{k - 1}" if k > 1 else over
            self.moves[here, "ANY"] = (after, None, 1.0, 0.0)
            self.moves[here, "BREAK"] = ("start", None, 1.0, 0.0)
            for name, (out, factor, added) in hits.items():
                self.moves[here, name] = (after, out, factor, added)

    def begins(self, state: str, words: int, trigger: str, into: str):
        """Reading ``trigger`` in ``state``, however far it has waited, leads ``into`` another."""
        for k in range(words, 0, -1):
            self.moves[state if k == words else f"{state}{k}", trigger] = (into, None, 1.0, 0.0)


def _after(trigger: str, words: int, hits: dict[str, tuple[str, float, float]]) -> Transducer:
    """After ``trigger``, for so many further words, ``hits`` are rewritten."""
    machine = Transducer({("start", trigger): ("near", None, 1.0, 0.0)})
    machine.waits("near", words, hits)
    machine.begins("near", words, trigger, "near")
    return machine


def _threat() -> Transducer:
    """Violence, then a person within four words; who does it must not be named unless intent is."""
    machine = Transducer(
        {
            ("start", "PERSON"): ("subject", None, 1.0, 0.0),
            ("start", "INTENT"): ("intent", None, 1.0, 0.0),
            ("start", "VIOLENCE"): ("armed", None, 1.0, 0.0),
        }
    )
    hit = {"PERSON": ("THREAT", 1.0, 4.0)}
    machine.waits("subject", 4, {})
    machine.begins("subject", 4, "PERSON", "subject")
    machine.begins("subject", 4, "INTENT", "intent")
    machine.begins("subject", 4, "VIOLENCE", "start")
    machine.waits("intent", 4, {})
    machine.begins("intent", 4, "INTENT", "intent")
    machine.begins("intent", 4, "VIOLENCE", "armed")
    machine.waits("armed", 4, hit)
    for k in range(4, 0, -1):  # one person is enough
        here = "armed" if k == 4 else f"armed{k}"
        machine.moves[here, "PERSON"] = ("start", "THREAT", 1.0, 4.0)
        machine.moves[here, "VIOLENCE"] = ("armed", None, 1.0, 0.0)
    return machine


def _speech() -> Transducer:
    """Reported until the clause ends, once a verb of speech or a quote has been read."""
    machine = Transducer(
        {("start", "SPEECH"): ("told", None, 1.0, 0.0), ("start", "QUOTE"): ("quoted", None, 1.0, 0.0)}
    )
    machine.moves["quoted", "QUOTE"] = ("start", None, 1.0, 0.0)
    for state in ("told", "quoted"):
        for name in ("INSULT", "AIMED", "THREAT"):
            machine.moves[state, name] = (state, "REPORTED", 0.5, 0.0)
    return machine


CASCADE = (
    _after("PERSON", 5, {"INSULT": ("AIMED", 1.25, 0.0)}),
    _after("INSULT", 3, {"PERSON": ("AIMED", 1.0, 0.5)}),
    _threat(),
    _after("NEGATION", 3, {x: ("DENIED", 0.4, 0.0) for x in ("INSULT", "AIMED", "THREAT")}),
    _speech(),
)
HEAVY = {"INSULT", "AIMED", "THREAT", "DENIED", "REPORTED"}
KNOWN_WORDS = 200_000  # remembered per worker, then forgotten; speed only


def _fixed_classes() -> dict[str, str]:
    classes = {word: "PERSON" for word in PERSONS}
    classes |= {word: "NEGATION" for word in NEGATIONS}
    classes |= {word: "SPEECH" for word in SPEECH}
    classes |= {word: "INTENT" for word in INTENT}
    classes |= {mark: "QUOTE" for mark in "\"“”«»"}
    classes |= {mark: "BREAK" for mark in ",:"}
    return classes | {word: "VIOLENCE" for word in VIOLENCE}


class Grammar:
    """Lexicon and cascade; ``stems`` maps word beginnings to weights, ``=word`` to whole words."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.longest = max((len(s) for s in stems), default=0)
        self.classes = _fixed_classes()
        self.known: dict[str, tuple[str, float]] = {}
        self.heads = ahocorasick.Automaton()
        for stem in stems:
            self.heads.add_word(stem.removeprefix("="), len(stem.removeprefix("=")))
        for word in VIOLENCE:
            self.heads.add_word(word, len(word))
        self.heads.make_automaton()

    def weight(self, word: str) -> float:
        """The heaviest entry that the word begins with, or is."""
        found = self.stems.get("=" + word, 0.0)
        for size in range(1, min(len(word), self.longest) + 1):
            found = max(found, self.stems.get(word[:size], 0.0))
        return found

    def symbol(self, word: str) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            weight = self.weight(word)
            found = ("INSULT", weight) if weight else (self.classes.get(word, "WORD"), 0.0)
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            if len(word) <= SHORT:
                self.known[word] = found
        return found

    def clauses(self, text: str) -> Iterator[Symbols]:
        """Classes of each clause in which some hostile word begins."""
        done = 0
        for end, size in self.heads.iter(text):
            start = end - size + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            for before in CLAUSE_END.finditer(text, done, start):
                done = before.end()
            after = CLAUSE_END.search(text, start)
            begin, done = done, after.start() if after else len(text)
            yield (self.symbol(word[0]) for word in WORD.finditer(text, begin, done))

    def features(self, text: str | None) -> list[float]:
        """Sums over matched clauses: full, discounted, heaviest, number, threats."""
        full = less = heaviest = 0.0
        matched = threats = 0
        for symbols in self.clauses((text or "").lower()):
            for machine in CASCADE:
                symbols = machine.read(symbols)
            score = discounted = 0.0
            threat = False
            for name, weight in symbols:
                if weight <= 0 or name not in HEAVY:
                    continue
                threat |= name == "THREAT"
                if name in ("DENIED", "REPORTED"):
                    discounted += weight
                else:
                    score += weight
            if not score and not discounted:
                continue
            full, less = full + score, less + discounted
            heaviest = max(heaviest, score + discounted)
            matched += 1
            threats += threat
        return [math.log1p(full), math.log1p(less), math.log1p(heaviest), math.log1p(matched), float(threats)]


def _entries(text: str) -> set[str]:
    """Words, marked ``=``, and beginnings of words in a text."""
    found = set()
    for word in set(re.findall(r"[^\W\d_]+", text.lower())):
        if len(word) > 2:
            found.add("=" + word)
        for size in PREFIXES:
            if size < len(word):
                found.add(word[:size])
    return found


def _counted(rows: DataFrame) -> DataFrame:
    """``(entry, fold, toxic, clean)``: texts that have an entry, by half of the sample and label."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                part, counts = batch.iloc[at : at + DOCS_AT_ONCE], Counter()
                for fold, toxic, text in zip(part["fold"], part["toxic"], part["text"]):
                    counts.update((entry, fold, toxic) for entry in _entries(text or ""))
                table = [(e, f, n * t, n * (1 - t)) for (e, f, t), n in counts.items()]
                yield pd.DataFrame(table, columns=["entry", "fold", "toxic", "clean"])

    counted = rows.mapInPandas(work, "entry string, fold int, toxic long, clean long")
    return counted.groupBy("entry").agg(
        *(
            F.sum(F.expr(f"CASE WHEN fold = {f} THEN {c} ELSE 0 END")).alias(f"{c}{f}")
            for f in (0, 1)
            for c in ("toxic", "clean")
        )
    )


def _own(entries: pd.Series, count: pd.Series) -> pd.Series:
    """For each beginning, the place of the longer entry (or itself as a word) that most of its texts have."""
    heads = {entry: place for place, entry in entries.items() if not entry.startswith("=")}
    longer: dict[int, int] = {}
    for place, entry in entries.items():
        word = entry.removeprefix("=")
        for size in range(min(PREFIXES), len(word) + (entry != word)):
            head = heads.get(word[:size])
            if head is not None and (head not in longer or count[place] > count[longer[head]]):
                longer[head] = place
    return pd.Series(longer, dtype="int64")


def _stems(counts: pd.DataFrame, toxic_docs: int, clean_docs: int, folds: tuple[int, ...]) -> dict[str, float]:
    """Entries that mark toxic texts, weighted by the logarithm of their odds.

    A beginning must do so also in the texts that its commonest longer entry does
    not explain; so one bad word leaves no harmless beginnings behind.
    """
    stems = {"=" + word: 1.0 for word in INSULTS}
    if not len(counts) or not toxic_docs or not clean_docs:
        return stems
    toxic = sum(counts[f"toxic{f}"] for f in folds)
    clean = sum(counts[f"clean{f}"] for f in folds)
    odds = (toxic / toxic_docs) / ((clean + 0.5) / (clean_docs + 1))
    good = (toxic >= LEAST_DOCS) & (odds >= LEAST_ODDS)
    longer = _own(counts["entry"], toxic)
    rest_toxic = toxic[longer.index] - toxic[longer].to_numpy()
    rest_clean = clean[longer.index] - clean[longer].to_numpy()
    rest_odds = (rest_toxic / toxic_docs) / ((rest_clean + 0.5) / (clean_docs + 1))
    good[longer.index] &= (rest_toxic >= LEAST_DOCS) & (rest_odds >= LEAST_ODDS)
    strength = (toxic[good] * np.log(odds[good])).sort_values(ascending=False, kind="stable")
    for place in strength.index[:STEMS]:
        stems[counts["entry"][place]] = float(np.log(odds[place]))
    return stems


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias by Newton's method with a small ridge."""
    x = np.hstack((x, np.ones((len(x), 1))))
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.01)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class ToxicityModel:
    stems: dict[str, float]
    weights: list[float]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out: str = "pmod(crc32(cast({key} AS string)), 5) = 0",
    rows: int = FIT_ROWS,
) -> ToxicityModel:
    """Learn stems and weights from labelled rows that are not held out.

    Of several labels of one document the larger holds, of several texts the
    smallest; rows with NULL in key or label teach nothing.  The documents are
    read once.  Without labels of both kinds the score is a constant.
    """
    usable = (
        labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("toxic"))
        .filter("id IS NOT NULL AND toxic IS NOT NULL AND NOT (" + held_out.format(key="id") + ")")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    total = usable.count()
    mixed = "pmod(xxhash64(id), 1000000007)"
    share = min(1.0, rows / max(1, total))
    chosen = usable.filter(f"{mixed} < {int(share * 1000000007)}").withColumn(
        "fold", F.expr(f"cast({mixed} % 2 AS int)")
    )
    # The sample is bounded by `rows`: 20,000 keys of 16 bytes, and a text for each.
    sample = checkpointed(
        docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "fold", "toxic")
        .agg(F.min("text").alias("text"))
        .select("fold", "toxic", "text")
        .repartition(FIT_PARTS)
    )
    by_label = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    toxic = [by_label.get((f, 1), 0) for f in (0, 1)]
    clean = [by_label.get((f, 0), 0) for f in (0, 1)]
    enough = F.col("toxic0") + F.col("toxic1") >= LEAST_DOCS
    odds = F.expr(
        f"((toxic0 + toxic1) / {max(1, sum(toxic))}) / ((clean0 + clean1 + 0.5) / {sum(clean) + 1})"
    )
    # The strongest entries only: four times as many as can be used, a bounded table.
    strongest = (
        _counted(sample)
        .filter(enough & (odds >= LEAST_ODDS / 2))
        .orderBy(((F.col("toxic0") + F.col("toxic1")) * F.log(odds)).desc(), "entry")
        .limit(4 * STEMS)
        .toPandas()
    )
    both = _stems(strongest, sum(toxic), sum(clean), (0, 1))
    if not sum(toxic) or not sum(clean):
        return ToxicityModel(both, [0.0] * FEATURES + [-3.0 if not sum(toxic) else 3.0])
    apart = [_stems(strongest, toxic[1 - f], clean[1 - f], (1 - f,)) for f in (0, 1)]

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammars = [Grammar(stems) for stems in apart]
        for batch in batches:
            found = [grammars[f].features(t) for f, t in zip(batch["fold"], batch["text"])]
            table = pd.DataFrame(found, columns=[f"x{k}" for k in range(FEATURES)])
            yield table.assign(y=batch["toxic"].to_numpy())

    schema = ", ".join(f"x{k} double" for k in range(FEATURES)) + ", y int"
    training = sample.mapInPandas(featured, schema).toPandas()
    x = training[[f"x{k}" for k in range(FEATURES)]].to_numpy(float)
    return ToxicityModel(both, _logistic(x, training["y"].to_numpy(float)).tolist())


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for each row.

    NULL counts as empty; an empty text gets the score of a text without any
    match.  Columns of these names in ``docs`` are replaced.
    """
    stems, weights = model.stems, np.array(model.weights)
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    at = own.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(stems)
        for batch in batches:
            texts = batch.column(at)
            found = [[*grammar.features(t.as_py()), 1.0] for t in texts]
            x = np.array(found, dtype=float).reshape(len(texts), FEATURES + 1)
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            columns = [*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, "score", "predicted"])

    kept = docs.select(*(F.col(f"`{c}`") for c in own))
    scores = StructType.fromDDL("score double, predicted int")
    schema = StructType(kept.schema.fields + scores.fields)
    return kept.mapInArrow(work, schema)
