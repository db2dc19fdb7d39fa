"""Operator 11: fill-in-middle transformation over SWAR words.

All texts of a batch lie in one buffer of UTF-8, seen as 64-bit words of eight bytes. A few
arithmetic steps on whole words mark the bytes that end a line; the marks of a word are counted
by one instruction, and running sums over the words number every line end of the batch. The end
of line ``k`` is found by binary search for its word in the running sums, and by arithmetic for
its byte in that word. No text is cut into lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.llm.common import ship, table, text_chunks, text_of

SEED, RATE, SPM = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_U = np.uint64
_ONES = _U(0x0101010101010101)
_HIGH = _U(0x8080808080808080)
_LOW = _U(0x7F7F7F7F7F7F7F7F)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as 64-bit words, byte 0 lowest; the last word, and one more, are filled up with zeros."""
    held = np.zeros((len(data) // 8 + 2) * 8, dtype=np.uint8)
    held[: len(data)] = data
    return held.view("<u8")


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of every byte that equals ``byte``, no other bit; no carry leaves a byte."""
    x = words ^ (_ONES * _U(byte))
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def inner_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that continues a code point (binary 10xxxxxx)."""
    return words & ~(words << _U(1)) & _HIGH


class Marks:
    """Marked bytes, counted up to a place and found by number."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks before the byte ``place``."""
        word, byte = place >> 3, (place & 7).astype(_U)
        inside = self.marks[word] & ((_U(1) << (byte << _U(3))) - _U(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The byte of the mark with this number, from 0."""
        word = np.searchsorted(self.before, number, side="right") - 1
        left = (number - self.before[word]).astype(_U)
        # Byte i of the product is the number of marks in bytes 0 to i.
        upto = (self.marks[word] >> _U(7)) * _ONES
        passed = ((left * _ONES) | _HIGH) - upto & _HIGH
        return (word << 3) + np.bitwise_count(passed)


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts and where each begins, with the end of the last."""
    held = texts.cast(pa.large_string())
    ends = np.frombuffer(held.buffers()[1], dtype=np.int64)[held.offset : held.offset + len(held) + 1]
    data = held.buffers()[2]
    letters = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    return letters[ends[0] : ends[-1]], ends - ends[0]


def cuts(letters: np.ndarray, edges: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lines of each text, the bytes where prefix and middle end, and the code points of both.

    ``edges`` has each text's first byte, with the end of the last; ``first`` and ``second`` are
    the drawn numbers, taken modulo lines plus one.
    """
    words = words_of(letters)
    lines, inner = Marks(equal_bytes(words, 0x0A)), Marks(inner_bytes(words))
    start, end = edges[:-1], edges[1:]
    before = lines.rank(start)
    open_end = (end > start) & (letters[np.maximum(end - 1, 0)] != 0x0A) if len(letters) else np.zeros(len(start), dtype=bool)
    n = lines.rank(end) - before + open_end
    a, b = first % (n + 1), second % (n + 1)

    def ending(units: np.ndarray) -> np.ndarray:
        place = np.where(units == n, end, start)
        within = (units > 0) & (units < n)
        place[within] = lines.select(before[within] + units[within] - 1) + 1
        return place

    one, two = ending(np.minimum(a, b)), ending(np.maximum(a, b))
    points = lambda x, y: (y - x) - (inner.rank(y) - inner.rank(x))
    return n, one, two, points(start, one), points(one, two)


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """The four numbers a document's id and the seed give; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns: ``row``, a struct of all columns of ``docs``, and ``fim``, what was made of its text.

    ``fim`` has the lines ``n``, the ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain) and the ``text`` to train on. Per hundred documents, ``rate`` are
    transformed, and ``spm`` of these with the suffix first. As the input's columns stay inside
    ``row``, no name clashes. A null text counts as empty, an empty one stays plain, and so does
    one that holds a sentinel, as it could not be restored. A null id draws like an empty one, and rows
    that repeat an id draw alike. A very long text is one value in one task; beside it, its words and
    marks take about five times its bytes. An empty table stays empty.
    """
    ship(docs.sparkSession)
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        text_of(text_col).alias("text"),
        *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col(id_col), seed), 1)],
    )
    made = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            letters, edges = _flat(batch["text"])
            h = [batch[f"h{i}"].to_numpy() for i in (1, 2, 3, 4)]
            n, one, two, prefix, middle = cuts(letters, edges, h[0], h[1])
            holds = [pc.match_substring(batch["text"], s) for s in (PREFIX, SUFFIX, MIDDLE)]
            taken = pc.or_(pc.or_(holds[0], holds[1]), holds[2]).to_numpy(zero_copy_only=False)
            plain = (edges[1:] == edges[:-1]) | taken | (h[2] % 100 >= rate)
            form = np.where(plain, "plain", np.where(h[3] % 100 < spm, "spm", "psm"))
            data, out = letters.tobytes(), []
            for kind, a, p, m, z in zip(form.tolist(), edges[:-1].tolist(), one.tolist(), two.tolist(), edges[1:].tolist(), strict=True):
                if kind == "plain":
                    out.append(data[a:z])
                elif kind == "psm":
                    out.append(b"".join((PREFIX.encode(), data[a:p], SUFFIX.encode(), data[m:z], MIDDLE.encode(), data[p:m])))
                else:
                    out.append(b"".join((SUFFIX.encode(), data[m:z], PREFIX.encode(), data[a:p], MIDDLE.encode(), data[p:m])))
            fields = [
                pa.array(n, pa.int64()),
                pa.array(form.tolist(), pa.string()),
                pa.array(prefix, pa.int64(), mask=plain),
                pa.array(middle, pa.int64(), mask=plain),
                pa.array(out, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.StructArray.from_arrays(fields, fields=list(made))], ["row", "fim"])

    schema = T.StructType(
        [
            T.StructField("row", source.schema["row"].dataType),
            T.StructField("fim", T.StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, text string")),
        ]
    )
    return source.mapInArrow(run, schema)


def restored(form: Column, text: Column) -> Column:
    """The text before the transformation, from its form and the transformed text alone."""
    rest = F.substring(text, len(PREFIX) + 1, 2**31 - 1)
    psm, spm = F.split(rest, f"{SUFFIX}|{MIDDLE}", -1), F.split(rest, f"{PREFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(F.get(psm, 0), F.get(psm, 2), F.get(psm, 1)))
        .when(form == "spm", F.concat(F.get(spm, 1), F.get(spm, 2), F.get(spm, 0)))
        .otherwise(text)
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"),
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.text"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim.form"), F.col("fim.text")), 256).alias("restored_sha256"),
    )


def oracle_sql() -> str:
    """The query over table ``documents`` for DuckDB, with lines as lists."""
    number = lambda i: f"CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)"
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), lines AS (
  SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units FROM texts
), drawn AS (
  SELECT *, len(units) AS n, {number(0)} % (len(units) + 1) AS a, {number(1)} % (len(units) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR {number(2)} % 100 >= {RATE} THEN 'plain'
      WHEN {number(3)} % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM lines
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:least(a, b)], ''), '') AS p,
    coalesce(array_to_string(units[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
    coalesce(array_to_string(units[greatest(a, b) + 1:], ''), '') AS s
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts"""
