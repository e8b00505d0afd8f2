"""Operator 12: fill-in-middle transformation by one repeated-capture match.

A text is cut into units (lines by default). One full match of ``(unit)*``
with the ``regex`` library keeps every repetition of its group, so
``match.ends(1)`` gives the number of units and both cut offsets at once.
Four 32-bit numbers of the sha256 of ``seed:id`` decide the cuts and the form,
so any task, any retry and any other program decides alike. No shuffle.

Forms, with the marks P, S and M: ``psm`` is P prefix S suffix M middle,
``spm`` is S suffix P prefix M middle, ``plain`` is the text itself.
:func:`restore` rebuilds the text from output and form with column expressions.

Cases: null text is empty; empty texts, texts that hold a mark and texts that
the units do not tile stay plain (the last with ``n`` 0); a null id counts as
the empty string; rows with equal ids are cut by equal numbers; columns of the
input are kept, those named like new ones are replaced.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chronoframe.llm.storage import document_batches

#: A line with its end, or what stands after the last one.
LINE = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")
ADDED = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
         StructField("middle_chars", LongType()), StructField("output", StringType())]


def check_marks(marks) -> tuple[str, str, str]:
    """Marks that can be found again whatever stands between them: where one begins, no other is under way."""
    marks = tuple(marks)
    if len(set(marks)) != 3 or not all(marks) or any(m[0] in other[1:] for m in marks for other in marks):
        raise ValueError("three different marks are needed, whose first signs stand nowhere else in them")
    return marks


def numbers(doc_id, seed) -> tuple[int, int, int, int]:
    """The first four groups of eight hex digits of sha256(``seed:id``)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[i:i + 8], 16) for i in (0, 8, 16, 24))


def transformed(text: str, h: tuple[int, int, int, int], unit, marks=MARKS, fim_percent: int = 100, spm_percent: int = 50) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text; ``unit`` is the compiled ``(unit)*``."""
    match = unit.fullmatch(text)
    ends = match.ends(1) if match else []
    n = len(ends)
    if not n or any(m in text for m in marks) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    p, s, m = marks
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, "".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", a, b - a, "".join((p, text[:a], s, text[b:], m, text[a:b]))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = LINE, seed: int | str = 7,
                   fim_percent: int = 100, spm_percent: int = 50, marks=MARKS) -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    marks = check_marks(marks)
    new = [f.name for f in ADDED]
    rest = [c for c in df.columns if c not in new]
    inner = document_batches(df).select(F.col(f"`{id_col}`").cast("string").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"),
                                        *[F.col(f"`{c}`") for c in rest])

    def run(batches):
        import regex

        units = regex.compile(f"({unit})*")
        for batch in batches:
            rows = [transformed(t or "", numbers(i, seed), units, marks, fim_percent, spm_percent)
                    for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(batch.columns[2:] + made, names=rest + new)

    return inner.mapInArrow(run, StructType([df.schema[c] for c in rest] + ADDED))


def restored(output: Column, form: Column, marks=MARKS) -> Column:
    """The text that ``output`` was made from; each mark stands in it once, so the first place is the right one."""
    p, s, m = check_marks(marks)

    def part(begin: Column, mark: str, end: Column | None = None) -> Column:
        """From behind ``mark`` at ``begin`` up to ``end``, or to the end of ``output``."""
        start = begin + len(mark)
        return F.substring(output, start, F.length(output) if end is None else end - start)

    at_p, at_s, at_m = (F.instr(output, x) for x in (p, s, m))
    psm = F.concat(part(at_p, p, at_s), part(at_m, m), part(at_s, s, at_m))
    spm = F.concat(part(at_p, p, at_m), part(at_m, m), part(at_s, s, at_p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", marks=MARKS) -> DataFrame:
    """``df`` with ``restored``, the text rebuilt from output and form alone."""
    return df.withColumn("restored", restored(F.col(f"`{output_col}`"), F.col(f"`{form_col}`"), marks))
