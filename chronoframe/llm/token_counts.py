"""Operator 7: token counts by prefix dynamic programming (see :mod:`prefix_bpe`) for a word-end BPE vocabulary.

The count of every prefix of a word is stored with its table, so "how many
tokens are in the first n characters" and "where does a budget of n tokens
end" are read off without encoding again. The vocabulary file (JSON of the
``tokenizers`` library) is read once on the driver and broadcast; its size is
fixed. Tasks work on their own rows: no shuffle.

Cases: null text counts as empty (0 bytes, 0 tokens); special strings inside a
text count as one token each, as the library does by default; the input's own
columns are kept, a column named like a new one is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.memories import held
from chronoframe.llm.prefix_bpe import END, REMEMBER, MergeTable
from chronoframe.llm.storage import document_batches


def _byte_symbols() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Tokens, merges, splitting pattern and special strings of a word-end BPE file, and a check that it is of that kind."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    mark = model.get("end_of_word_suffix")
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or not mark or kinds != ["NFC", "Replace", "Lowercase"]:
        raise ValueError("expected a lower-casing BPE vocabulary with word ends")
    symbol = _byte_symbols()

    def raw(token: str) -> bytes:
        body, end = (token[:-len(mark)], END) if token.endswith(mark) else (token, b"")
        return bytes(symbol[c] for c in body) + end

    special = [t["content"] for t in spec["added_tokens"] if t["special"]]
    ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
    pairs = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        pairs.setdefault((ids[raw(left)], ids[raw(right)]), rank)
    pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return {"table": MergeTable(ids, pairs), "pattern": pattern, "special": special}


def lower(text: str) -> str:
    """Lower-case each character by itself (no final sigma)."""
    return (text.replace("\u03a3", "\u03c3") if "\u03a3" in text else text).lower()


class WordCounts(dict):
    """Word to its token count, a bounded memory of words already counted."""

    def __init__(self, table: MergeTable):
        self.table = table

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        out = self[word] = len(self.table.encode(word.encode("utf-8") + END))
        return out

    def prefix(self, word: str) -> list[int]:
        """Token count of every prefix of a word, each taken as a word of its own."""
        raw = word.encode("utf-8")
        open_table = self.table.table(raw)
        at = [0, *accumulate(len(c.encode("utf-8")) for c in word)]
        out = [0]
        for n in at[1:]:
            part = raw[:n] + END
            out.append(len(self.table.read(part, self.table.table(part, open_table[:n]))))
        return out


class Counter:
    """Counts of whole texts and of their prefixes."""

    def __init__(self, spec: dict):
        import regex

        self.words = WordCounts(spec["table"])
        self.pattern = regex.compile(spec["pattern"])
        self.special = re.compile("|".join(map(re.escape, sorted(spec["special"], key=len, reverse=True))) or r"(?!)")

    def _plain(self, text: str) -> str:
        return lower(text if text.isascii() else unicodedata.normalize("NFC", text))

    def count(self, text: str) -> int:
        if "<|" in text:
            found = self.special.findall(text)
            return len(found) + sum(self.count(x) if "<|" not in x else self._count(x) for x in self.special.split(text)) if found else self._count(text)
        return self._count(text)

    def _count(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.pattern.findall(self._plain(text))))

    def fits(self, text: str, budget: int) -> int:
        """Tokens within the budget, ended at a word or inside it: the largest number of whole words of the plain text, then of
        characters of the next word, whose tokens are at most ``budget``; given as a position in the normalised text."""
        plain, used, at = self._plain(text), 0, 0
        for m in self.pattern.finditer(plain):
            n = self.words[m[0]]
            if used + n > budget:
                inner = self.words.prefix(m[0])
                return max((m.start() + k for k, c in enumerate(inner) if k and used + c <= budget), default=at)
            used, at = used + n, m.end()
        return len(plain)


def token_counts(df: DataFrame, path: str, text_col: str = "text", limit: int = 2048) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars`` (characters of the normalised text within the limit)."""
    added = ["n_bytes", "n_tokens", "over_limit", "fit_chars"]
    rest = [c for c in df.columns if c not in added]
    shared = document_batches(df).sparkSession.sparkContext.broadcast({"key": path, "spec": read_vocabulary(path)})

    def run(batches):
        counter = held(shared.value["key"], lambda: Counter(shared.value["spec"]))
        for batch in batches:
            size, count, fits = [], [], []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                s = text or ""
                size.append(len(s.encode("utf-8")))
                count.append(n := counter.count(s))
                fits.append(counter.fits(s, limit) if n > limit else None)
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            cols |= {"n_bytes": pa.array(size, pa.int64()), "n_tokens": pa.array(count, pa.int64()), "over_limit": pa.array([n > limit for n in count], pa.bool_()), "fit_chars": pa.array(fits, pa.int64())}
            yield pa.RecordBatch.from_pydict(cols)

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest]
    kinds += ["n_bytes long", "n_tokens long", "over_limit boolean", "fit_chars long"]
    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, ", ".join(kinds))
