"""Fill-in-the-middle: a text is cut at two places between units and its parts
are put in another order around marks.

Units are maximal runs of ASCII letters and single other code points.  The text
is held as UTF-8 and seen as blocks of a fixed size; a Fenwick tree over the
blocks stores how many units and how many code points begin in each.  A cut
after u units is the beginning of unit u: binary lifting descends the tree to
the block that holds it, and only that block is looked at to place the cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import arrow_batches, pack, text_bytes

#: The marks before prefix, suffix and middle.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Of 100 texts with units so many are cut, and of 100 cut ones so many put the suffix first.
CUT_OF_100, SUFFIX_FIRST_OF_100 = 90, 20
#: Bytes of one block of a text.
BLOCK_BYTES = 1024
#: Rows of an Arrow batch (each text goes in and comes out).
BATCH_ROWS = 250
SALT = "1"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Cut(NamedTuple):
    """A place in a text: bytes and code points before it."""

    at: int
    chars: int


class UnitIndex:
    """Fenwick tree over the blocks of one text: units and code points."""

    def __init__(self, text: bytes, block: int = BLOCK_BYTES):
        self.text, self.block = text, block
        buf = np.frombuffer(text, np.uint8)
        self.begins = (buf & 0xC0) != 0x80  # code points
        letter = _LETTER[buf]
        self.units = self.begins.copy()
        self.units[1:] &= ~(letter[1:] & letter[:-1])
        blocks = -(-len(buf) // block)
        edges = np.arange(0, len(buf), block)
        self.tree = np.zeros((blocks + 1, 2), np.int64)
        if blocks:
            self.tree[1:, 0] = np.add.reduceat(self.units, edges, dtype=np.int64)
            self.tree[1:, 1] = np.add.reduceat(self.begins, edges, dtype=np.int64)
        for i in range(1, blocks + 1):  # each node adds itself to its parent
            up = i + (i & -i)
            if up <= blocks:
                self.tree[up] += self.tree[i]
        self.n_units, self.n_chars = self._prefix(blocks)

    def _prefix(self, blocks: int) -> tuple[int, int]:
        total = np.zeros(2, np.int64)
        while blocks:
            total += self.tree[blocks]
            blocks &= blocks - 1
        return int(total[0]), int(total[1])

    def cut(self, units: int) -> Cut:
        """The place after the first ``units`` units (all of them at most)."""
        if units >= self.n_units:
            return Cut(len(self.text), self.n_chars)
        blocks, at = len(self.tree) - 1, 0
        left, chars = units, 0
        step = 1 << blocks.bit_length()
        while step:  # the most blocks that hold no more than ``units`` units
            if at + step <= blocks and self.tree[at + step, 0] <= left:
                at += step
                left -= int(self.tree[at, 0])
                chars += int(self.tree[at, 1])
            step >>= 1
        start = at * self.block
        here = int(np.flatnonzero(self.units[start : start + self.block])[left])
        return Cut(start + here, chars + int(np.count_nonzero(self.begins[start : start + here])))


class Plan(NamedTuple):
    """What becomes of one text: its units, form and cuts (None if plain)."""

    n: int
    form: str
    first: Cut | None
    last: Cut | None


def draws(key: str, salt: str = SALT) -> list[int]:
    """Four numbers below 2^32, fixed by the salt and the row's key."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def plan_cuts(text: bytes, key: str, salt: str = SALT, block: int = BLOCK_BYTES) -> Plan:
    index = UnitIndex(text, block)
    h = draws(key, salt)
    if not text or any(m in text for m in MARKS.values()) or h[2] % 100 >= CUT_OF_100:
        return Plan(index.n_units, "plain", None, None)
    first, last = sorted(x % (index.n_units + 1) for x in h[:2])
    form = "spm" if h[3] % 100 < SUFFIX_FIRST_OF_100 else "psm"
    return Plan(index.n_units, form, index.cut(first), index.cut(last))


def transform(text: bytes, plan: Plan) -> bytes:
    if plan.form == "plain":
        return text
    part = {"prefix": text[: plan.first.at], "middle": text[plan.first.at : plan.last.at], "suffix": text[plan.last.at :]}
    order = ("prefix", "suffix", "middle") if plan.form == "psm" else ("suffix", "prefix", "middle")
    return b"".join(MARKS[p] + part[p] for p in order)


def restore(output: bytes, form: str) -> bytes:
    """The text a transformed one was made from.  The text holds no mark, so
    each mark is found at its first place."""
    if form == "plain":
        return output
    order = ("prefix", "suffix", "middle") if form == "psm" else ("suffix", "prefix", "middle")
    part, rest = {}, output[len(MARKS[order[0]]) :]
    for name, following in zip(order, order[1:]):
        part[name], _, rest = rest.partition(MARKS[following])
    part[order[-1]] = rest
    return part["prefix"] + part["middle"] + part["suffix"]


RESULT = ("n long, form string, prefix_bytes long, middle_bytes long, prefix_chars long, middle_chars long, "
          "output string, restored_sha256 string")


def _transform_udf(salt: str):
    @F.arrow_udf(f"struct<{RESULT.replace(' ', ':').replace(',:', ',')}>")
    def rewrite(rows: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, texts in rows:
            out = []
            for key, text in zip(keys.to_pylist(), text_bytes(texts)):
                p = plan_cuts(text, "" if key is None else key, salt)
                made = transform(text, p)
                a, b = p.first, p.last
                out.append({
                    "n": p.n, "form": p.form,
                    "prefix_bytes": a and a.at, "middle_bytes": a and b.at - a.at,
                    "prefix_chars": a and a.chars, "middle_chars": a and b.chars - a.chars,
                    "output": made.decode(), "restored_sha256": hashlib.sha256(restore(made, p.form)).hexdigest()})
            yield pa.array(out, pa.struct([
                ("n", pa.int64()), ("form", pa.string()), *[(c, pa.int64()) for c in (
                    "prefix_bytes", "middle_bytes", "prefix_chars", "middle_chars")],
                ("output", pa.string()), ("restored_sha256", pa.string())]))

    return rewrite


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = SALT) -> DataFrame:
    """``_row`` (all columns of ``docs``) and ``fim``: number of units, form
    (``plain``, ``psm`` or ``spm``), bytes and code points of prefix and middle (null
    if plain), the output text, and the digest of the text restored from it.

    A null text is the empty one, which stays plain, as does a text that holds a
    mark.  The cuts follow from the salt, the id (null: the empty string) and the
    text alone: repeated rows get equal results, and lost tasks redo the same.  An
    empty table gives an empty result; clashing column names stay in ``_row``.
    """
    arrow_batches(docs.sparkSession, BATCH_ROWS)
    packed = pack(docs)
    return packed.select("_row", _transform_udf(salt)(F.col(f"_row.`{id_col}`").cast("string"), F.col(f"_row.`{text_col}`")).alias("fim"))


def oracle_sql() -> str:
    """The digest columns of the registered query in DuckDB SQL."""
    return f"""
    WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                      sha256('{SALT}:' || doc_id) AS digest FROM documents),
    h AS (SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
                 {", ".join(f"CAST('0x' || substr(digest, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))} FROM u),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                           OR h3 % 100 >= {CUT_OF_100} THEN 'plain'
                      WHEN h4 % 100 < {SUFFIX_FIRST_OF_100} THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT doc_id, n, form, text, array_to_string(units[1:a], '') AS prefix,
                 array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256 FROM p"""
