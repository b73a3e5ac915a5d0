"""Fill-in-the-middle transformation, cut through an indexable skip list.

A text is a row of units, ``[A-Za-z]+|[^A-Za-z]``. Its units are the ground lane of a skip
list whose express lanes hold ever fewer of them, promoted by a fixed hash of their rank.
Each link of a lane carries two widths: how many units and how many code points it
spans. A search for a rank walks a lane while the next link's unit width still fits,
descends, and adds up both widths, so it ends at the cut's rank and its code point at
once. Lanes are arrays (a link is followed by the next entry, ``down`` is its place one
lane below), built without a step per unit in Python.

The cuts, the form and their chances come from the sha256 of ``1:`` and the decimal id,
so a row is transformed alike in every task and run. Texts that are empty or hold a sentinel
stay plain, whatever their id. Null texts are empty texts; a null id hashes as ``1:``.
Repeated rows get equal results; an empty table gives no rows; other columns are ignored.
Lone code points beyond the letters are units of their own; texts are used whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import map_arrow, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of the texts that are transformed, and of these in suffix-prefix-middle order.
FIM_PERCENT, SPM_PERCENT = 90, 20
#: A unit reaches the next lane with one chance in 2**PROMOTE.
PROMOTE = 3

_LETTER = np.zeros(128, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class SkipList:
    """The units of one text under express lanes that carry unit and code-point widths."""

    def __init__(self, text: str) -> None:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = (code < 128) & _LETTER[code & 127]
        start = ~letter
        start[:1] = True
        start[1:] |= ~letter[:-1]
        at = np.flatnonzero(start)
        self.n, self.n_chars = len(at), len(code)
        chars = np.diff(at, append=len(code))
        rank = np.arange(self.n)
        #: Lanes from the ground up: unit widths, code-point widths, places one lane below.
        self.lanes = [(np.ones(self.n, np.int64), chars, rank)]
        if self.n < 1 << PROMOTE:
            return
        high = _levels(self.n)
        for level in range(1, int(high[1:].max(initial=0)) + 1):
            down = np.flatnonzero(high >= level)  # each lane begins with the first unit
            units, chars, _ = self.lanes[-1]
            high = high[down]
            self.lanes.append((np.add.reduceat(units, down), np.add.reduceat(chars, down), down))

    def descend(self, rank: int) -> int:
        """The code points before the unit of this rank (all of them for rank n)."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        node = seen_units = seen_chars = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            units, chars, down = self.lanes[level]
            while node < len(units) and seen_units + units[node] <= rank:
                seen_units += int(units[node])
                seen_chars += int(chars[node])
                node += 1
            if seen_units == rank:
                return seen_chars
            node = int(down[node])
        raise AssertionError("widths of the lanes do not add up")


def _levels(n: int) -> np.ndarray:
    """How many lanes above the ground each rank reaches: trailing zeros of a fixed hash, in steps of PROMOTE."""
    with np.errstate(over="ignore"):
        h = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    out = np.zeros(n, np.int8)
    for level in range(1, 64 // PROMOTE):
        up = (h & np.uint64((1 << PROMOTE * level) - 1)) == 0
        if not up.any():
            break
        out[up] = level
    out[0] = 127
    return out


def draws(doc_id) -> tuple[int, int, int, int]:
    """The four numbers that a document's id decides its cuts and form by."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def transform_text(text: str, doc_id, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, str]:
    """``(units, form, prefix code points, middle code points, output)``."""
    h1, h2, h3, h4 = draws(doc_id)
    lanes = SkipList(text)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= fim_percent:
        return lanes.n, PLAIN, None, None, text
    a, b = sorted((h1 % (lanes.n + 1), h2 % (lanes.n + 1)))
    i, j = lanes.descend(a), lanes.descend(b)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < spm_percent:
        return lanes.n, SPM, i, j - i, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return lanes.n, PSM, i, j - i, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _run(fim_percent: int, spm_percent: int):
    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 64):  # few outputs at a time: they are as long as the texts
                ids, texts = b.column("doc_id").slice(k, 64), b.column("text").slice(k, 64)
                got = [transform_text(t, i, fim_percent, spm_percent) for i, t in zip(ids.to_pylist(), texts.to_pylist())]
                n, form, prefix, middle, out = map(list, zip(*got))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(out, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per row: doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output (the transformed text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, _run(fim_percent, spm_percent),
                     f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of, from output and form alone. A sentinel begins with a character
    that it holds nowhere else, so its first find is the one that was put there."""
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        i, j = F.instr(output, second), F.instr(output, MIDDLE)
        one = F.substring(output, F.lit(len(first) + 1), i - len(first) - 1)
        two = F.substring(output, i + len(second), j - i - len(second))
        return one, two, F.substring(output, j + len(MIDDLE), F.length(output))

    p, s, m = parts(PREFIX, SUFFIX)
    s2, p2, m2 = parts(SUFFIX, PREFIX)
    return F.when(form == PLAIN, output).when(form == PSM, F.concat(p, m, s)).otherwise(F.concat(p2, m2, s2))


def digests(transformed: DataFrame) -> DataFrame:
    """``transform``'s rows with digests of the output and of the text rebuilt from it, in place of the output."""
    kept = transformed.select("*", F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
                              F.sha2(F.encode(restored(F.col("output"), F.col("form")), "UTF-8"), 256).alias("restored_sha256"))
    return kept.drop("output")
