"""Operator 8: toxicity by noisy-channel deobfuscation, then scoring of the restored text.

*Language model*: letter 4-gram counts of the whole corpus (all rows, whole
texts), smoothed down to shorter contexts. *Channel*: what a writer may have
put for a letter (look-alike signs, repeats, separators between letters).
Tokens that a plain reading does not settle become a lattice of letters; a
Viterbi search over the last three letters finds the likeliest reading.
*Score*: prefixes of restored words learnt from labels (words of two or three
letters whole, in scripts without spaces every run of two to four signs); every
one that enough toxic rows have, with precision 0.9, is weighed. Rules are picked
greedily, each the one that explains most toxic rows not explained so far
(so a copied document cannot bring in its whole vocabulary); a text's score
joins the precisions of the rules that it meets.

Labels are learnt from a bounded sample (``TOXIC_ROWS`` and ``CLEAN_ROWS``
labelled rows, least hash of the id first), whose ids are broadcast; the
corpus counts cover everything. Scoring needs no shuffle.

Cases: null text is empty; empty text, or no labels at all, gives the rate of
toxic rows among those without a rule (0 without labels); rows with null id
or null label teach nothing; conflicting labels of one id count as toxic;
repeated rows are scored each; columns of the input are kept, those named
like new ones are replaced.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.language_id import pieces
from chronoframe.llm.memories import release
from chronoframe.llm.storage import checkpointed, document_batches

TOXIC_ROWS, CLEAN_ROWS = 20_000, 40_000
SHORTEST, LONGEST = 4, 8
#: Stems that a task counts before it sends them on.
STEM_COUNTS = 400_000
#: Tokens kept with their meaning: while scoring (almost always none), and while counting stems (up to five strings each).
TOKEN_CACHE, STEM_CACHE = 300_000, 60_000
OTHER = 27

# Fixed values of the channel: signs written for a letter, with their log probability.
LOOKALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¢": "c",
}
LOOKALIKE_COST, DOUBLE_COST, MANY_COST, DROP_COST, BREAK_COST, HIDDEN_COST = -0.3, -1.5, -2.0, -0.3, -1.5, -3.0
SEPARATORS = ".,-_*'~/:·+ "
HIDDEN = "*#"                       # stands for any one letter


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: 0 no letter, 1-26 a-z (accents off, capitals lowered), 27 another letter."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            base = unicodedata.normalize("NFD", ch)[0].lower() if c < 0x2000 else ch
            out[c] = ord(base) - 96 if "a" <= base <= "z" else OTHER
    return out


def corpus_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(code, n)``: counts of letter 4-grams over every row; a code has four classes of five bits."""
    def count(batches):
        release()
        total = np.zeros(1 << 20, dtype=np.int64)
        table = _classes()
        for batch in batches:
            for _, points, bounds in pieces(batch.column(0).to_pylist()):
                total += four_grams(table[points], bounds)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(code.astype(np.int64)), "n": pa.array(total[code])})

    return df.select(F.col(text_col).alias("text")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def four_grams(symbol: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of the 4-grams of the letter classes; three blanks before each text, every run of other characters one blank."""
    before = np.zeros(len(symbol), dtype=bool)
    before[1:] = symbol[:-1] > 0
    before[bounds[:-1][bounds[:-1] < len(symbol)]] = False
    keep = (symbol > 0) | before
    kept = np.concatenate(([0], np.cumsum(keep)))[bounds]
    seq = np.insert(symbol[keep].astype(np.int32), np.repeat(kept[:-1], 3), 0)
    if len(seq) < 4:
        return np.zeros(1 << 20, dtype=np.int64)
    code = seq[:-3] << 15 | seq[1:-2] << 10 | seq[2:-1] << 5 | seq[3:]
    return np.bincount(code, minlength=1 << 20)


def log_probabilities(code: np.ndarray, n: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """log P(letter | three before), each context smoothed by the next shorter one."""
    count = np.zeros(1 << 20)
    count[code] = n
    count = count.reshape(32, 32, 32, 32)
    p = np.full(32, 1 / 28)
    for c in (count.sum((0, 1, 2)), count.sum((0, 1)), count.sum(0), count):
        p = (c + weight * p) / (c.sum(-1, keepdims=True) + weight)
    return np.log(p).reshape(-1).astype(np.float32)


class Restorer:
    """Token to its restored words."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp

    def _options(self, ch: str, prev: str, run: int) -> list[tuple[str, float]]:
        """Letters that an observed character may stand for; '' nothing, ' ' a word border."""
        if ch.isalpha():
            base = unicodedata.normalize("NFD", ch)[0].lower()
            out = [(base if "a" <= base <= "z" else ch, 0.0)]
            if ch == prev:
                out = [(out[0][0], MANY_COST * (run - 1)), ("", DOUBLE_COST if run == 1 else DROP_COST)]
            return out
        out = [(x, LOOKALIKE_COST) for x in LOOKALIKE.get(ch, "")]
        if ch in SEPARATORS:
            out += [("", DROP_COST), (" ", BREAK_COST)]
        if ch in HIDDEN:
            out += [(chr(97 + k), HIDDEN_COST) for k in range(26)]
        return out + [("", DROP_COST)] if ch == prev and ch in LOOKALIKE else out or [(" ", BREAK_COST)]

    def decode(self, token: str) -> str:
        """The likeliest reading by Viterbi search; a state is the last three letters."""
        logp, states = self.logp, {0: (0.0, "")}
        prev, run = "", 0
        for ch in token:
            run = run + 1 if ch == prev else 0
            options = self._options(ch, prev, run)
            nxt: dict[int, tuple[float, str]] = {}
            for state, (score, text) in states.items():
                for letter, cost in options:
                    if letter == "" or letter == " " and not state & 31:
                        to, s, t = state, score + cost, text
                    else:
                        c = 0 if letter == " " else ord(letter) - 96 if "a" <= letter <= "z" else OTHER
                        code = state << 5 | c
                        to, s, t = code & 0x7FFF, score + cost + float(logp[code]), text + letter
                    if to not in nxt or s > nxt[to][0]:
                        nxt[to] = (s, t)
            states, prev = nxt, ch
        return max((s + (float(logp[state << 5]) if state & 31 else 0.0), t) for state, (s, t) in states.items())[1]

    def undoubled(self, word: str) -> str:
        """The likeliest reading of a word of letters that drops at least one of its doubled letters, by the same search."""
        logp, states = self.logp, {(0, False): (0.0, "")}
        prev = ""
        for ch in word:
            nxt: dict[tuple[int, bool], tuple[float, str]] = {}
            for letter, cost in self._options(ch, prev, 1 if ch == prev else 0):
                c = ord(letter) - 96 if "a" <= letter <= "z" else OTHER if letter else 0
                for (state, dropped), (score, text) in states.items():
                    if letter == "":
                        to, s, t = (state, True), score + cost, text
                    else:
                        code = state << 5 | c
                        to, s, t = (code & 0x7FFF, dropped), score + cost + float(logp[code]), text + letter
                    if to not in nxt or s > nxt[to][0]:
                        nxt[to] = (s, t)
            states, prev = nxt, ch
        return max((s + float(logp[state << 5]), t) for (state, dropped), (s, t) in states.items() if dropped)[1]

    def words(self, token: str) -> list[str]:
        """Words of a lower-case token: its plain reading, and the restored ones where that is not settled.

        A doubled letter may be a disguise or not: such a word also gives its
        likeliest reading with fewer of them, and the one with none.
        """
        core = token.strip(_EDGE)
        if len(token) - len(core) > 2 or not core.isalpha():        # else there is no junk: it takes three signs
            token = _JUNK.sub("", token)
            core = token.strip(_EDGE)
        if core.isalpha() and not _TRIPLE.search(core):
            return list(dict.fromkeys([core, self.undoubled(core), _DOUBLE.sub(r"\1", core)])) if _DOUBLE.search(core) else [core]
        plain = _WORD.findall(token)
        noisy = token.strip(".,;:?\"'()[]{}<>%&~^`=-_/\\")
        if not any(c.isalpha() for c in noisy) and not any(c in LOOKALIKE for c in noisy):
            return plain
        return plain + [w for w in self.decode(noisy).split(" ") if w and w not in plain]


_EDGE = ".,;:!?\"'()[]{}<>|%&#*~^`=-_/\\«»„“”"
_DOUBLE = re.compile(r"(.)\1")
_RUN = re.compile(r"(.)\1+")
_TRIPLE = re.compile(r"(.)\1\1")
_JUNK = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}[.,;:]*$")
_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]{1,2}\S){2,}(?!\S)")
_MAYBE_SPACED = re.compile(r"\S[ \t]{1,2}\S[ \t]{1,2}\S(?!\S)")


_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]{2,}")


def stems(word: str) -> list[str]:
    """Prefixes of a word; of two or three letters the whole word; in scripts without spaces every run of two to four signs."""
    if 1 < len(word) < SHORTEST:
        out = [word]
    else:
        out = [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)]
    for run in _UNSPACED.findall(word):
        out += [run[i:i + k] for k in range(2, SHORTEST + 1) for i in range(len(run) - k + 1)]
    return out


class TokenMemo(dict):
    """Token to whatever ``make`` says of its restored words; a bounded memory."""

    def __init__(self, restorer: Restorer, make, most: int = TOKEN_CACHE):
        self.restorer, self.make, self.most = restorer, make, most

    def __missing__(self, token: str):
        if len(self) >= self.most:
            self.clear()
        out = self[token] = self.make(self.restorer.words(token))
        return out

    def of(self, text: str) -> set:
        """All that the tokens of a text say, spaced-out letters read as one token."""
        text = text.lower()
        found = set().union(*filter(None, map(self.__getitem__, text.split())))
        if _MAYBE_SPACED.search(text):
            for m in _SPACED.findall(text):
                found |= self[m.replace("\t", " ")]
        return found


class _Plain(dict):
    """For ``str.translate``: letters as :meth:`Restorer.undoubled` reads them."""

    def __missing__(self, point: int) -> str:
        ch = chr(point)
        base = unicodedata.normalize("NFD", ch)[0].lower()
        out = self[point] = base if "a" <= base <= "z" else ch
        return out


class KnownStems(TokenMemo):
    """Token to those of the ``known`` stems that its restored words have.

    The readings of a word of letters differ in doubled letters and accents
    alone. So a known stem that one of them has begins the word, both with
    their runs of a letter made single; a word that none begins is not restored.
    """

    def __init__(self, restorer: Restorer, known, most: int = TOKEN_CACHE):
        super().__init__(restorer, lambda words: frozenset(s for w in words for s in stems(w) if s in known), most)
        self.heads = {_RUN.sub(r"\1", s) for s in known}
        self.sizes = sorted({len(h) for h in self.heads})
        self.plain = _Plain()

    def begins(self, word: str) -> bool:
        for k in self.sizes:
            if word[:k] in self.heads:
                return True
        return False

    def without(self, token: str) -> bool:
        """Whether no reading can have a known stem (false: restore it and see)."""
        core = token.strip(_EDGE)
        if len(token) - len(core) > 2 or not core.isalpha() or _TRIPLE.search(core):
            return False
        if core.isascii():
            return not self.begins(_RUN.sub(r"\1", core.lower()))
        return not (_UNSPACED.search(core) or self.begins(_RUN.sub(r"\1", core)) or self.begins(_RUN.sub(r"\1", core.translate(self.plain))))

    def __missing__(self, token: str) -> frozenset:
        if not self.without(token):
            return super().__missing__(token)
        if len(self) >= self.most:
            self.clear()
        self[token] = frozenset()
        return self[token]


@dataclass
class ToxicityModel:
    logp: np.ndarray
    rules: dict[str, float] = field(default_factory=dict)      # stem: precision
    base: float = 0.0

    def hits(self, words: list[str]) -> frozenset:
        return frozenset(s for w in words for s in stems(w) if s in self.rules)

    def score(self, hits) -> float:
        clean = 1.0 - self.base
        for h in hits:
            clean *= 1.0 - self.rules[h]
        return 1.0 - clean


def _sample(labels: DataFrame, id_col: str, label_col: str, rows: dict[int, int]) -> DataFrame:
    """At most ``rows[y]`` ids of each label, by least hash: the stated bound of what is broadcast."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__y"))
    parts = [one.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(n) for y, n in rows.items()]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learn from the rows of ``labels`` (and their texts in ``docs``); letter counts from ``corpus`` (default: ``docs``)."""
    document_batches(docs)
    rows = corpus_counts(docs if corpus is None else corpus, text_col).toPandas()      # at most 2**20 rows: one for each 4-gram
    model = ToxicityModel(log_probabilities(rows["code"].to_numpy(dtype=np.int64), rows["n"].to_numpy()))
    sample = F.broadcast(_sample(labels, id_col, label_col, {1: TOXIC_ROWS, 0: CLEAN_ROWS}))
    known = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")).join(sample, "__id")
    logp = model.logp

    def count_stems(batches):
        memo, total, seen = TokenMemo(Restorer(logp), lambda words: frozenset(s for w in words for s in stems(w)), STEM_CACHE), (Counter(), Counter()), [0, 0]

        def sent():
            kinds = [pa.array([s for y in (0, 1) for s in ("", *total[y])], pa.string())]
            kinds += [pa.array([n if y == of else 0 for y in (0, 1) for n in (seen[y], *total[y].values())], pa.int64()) for of in (1, 0)]
            return pa.RecordBatch.from_arrays(kinds, ["stem", "toxic", "clean"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[y].update(memo.of(text or ""))
                seen[y] += 1
                if len(total[0]) + len(total[1]) > STEM_COUNTS:       # sums are taken later: what is counted may go
                    yield sent()
                    total, seen = (Counter(), Counter()), [0, 0]
        yield sent()

    counts = known.select("text", F.col("__y").cast("int")).mapInArrow(count_stems, "stem string, toxic long, clean long")
    counts = checkpointed(counts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    rows_seen = counts.where("stem = ''").first()
    n_toxic, n_clean = (rows_seen["toxic"], rows_seen["clean"]) if rows_seen else (0, 0)
    least = max(2, math.ceil(0.004 * n_toxic))
    passed = counts.where((F.col("stem") != "") & (F.col("toxic") >= least) & (F.col("toxic") >= 0.9 * (F.col("toxic") + F.col("clean"))))
    good = {r["stem"]: (r["toxic"] + 0.5) / (r["toxic"] + r["clean"] + 1) for r in passed.collect()}       # what passes, all of it

    def list_good(batches):
        memo = KnownStems(Restorer(logp), good, STEM_CACHE)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"stems": pa.array([sorted(memo.of(t or "")) for t in batch.column(0).to_pylist()], pa.list_(pa.string()))})

    lists = [set(r["stems"]) for r in known.where("__y = 1").select("text").mapInArrow(list_good, "stems array<string>").collect()]   # at most TOXIC_ROWS
    model.rules = {s: good[s] for s in pick_rules(lists, good, least)}
    missed = sum(1 for x in lists if not x & model.rules.keys())
    model.base = missed / max(1, missed + n_clean)
    return model


def pick_rules(lists: list[set], good: dict[str, float], least: int) -> list[str]:
    """Greedy cover of the toxic rows, then further stems whose rows have little else in common (copies share all they have)."""
    rules, left = [], list(lists)
    while gain := Counter(s for x in left for s in x):
        best = max(gain, key=lambda s: (gain[s], good[s], len(s), s))
        if gain[best] < max(2, least / 2):
            break
        rules.append(best)
        left = [x for x in left if best not in x]
    rows: dict[str, list[set]] = {}
    for x in lists:
        for s in x:
            rows.setdefault(s, []).append(x)
    for s in sorted(rows, key=lambda s: (-len(rows[s]), -len(s), s)):
        if any(s == r or min(len(s), len(r)) >= SHORTEST and (s.startswith(r) or r.startswith(s)) for r in rules):
            continue
        own = rows[s]
        alike = sum(len(a & b) > 0.5 * len(a | b) and len(a | b) > 8 for a, b in zip(own, own[1:]))
        if len(own) - alike >= max(8, least):
            rules.append(s)
    return rules


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    added = ["score", "predicted"]
    rest = [c for c in df.columns if c not in added]
    shared = document_batches(df).sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        model = shared.value
        memo = KnownStems(Restorer(model.logp), model.rules)
        for batch in batches:
            values = [model.score(memo.of(t.as_py() or "")) for t in batch.column(batch.schema.get_field_index(text_col))]
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            cols |= {"score": pa.array(values, pa.float64()), "predicted": pa.array([int(v >= threshold) for v in values], pa.int32())}
            yield pa.RecordBatch.from_pydict(cols)

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + ["score double", "predicted int"]
    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, ", ".join(kinds))
