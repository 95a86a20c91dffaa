"""Lookups of many small things per row in a table that is too large to broadcast.

A block is a stretch of rows of one task with a dictionary of its own: the distinct
words (or ids) of its rows, and each row's words as their places in it.  Blocks are
written once.  Only their dictionaries are joined with the table, one row for each
distinct word of a block; the answers return to their block, where each row's places
are replaced by them.  A frequent word costs one row a block and no text is moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paracorpus.session import written

#: Words of a block: it ends with the slice of rows that reaches them.
BLOCK_WORDS, SLICE_ROWS = 1 << 20, 256
#: Words that a task counts before it hands the counts on.
COUNTED = 1 << 22
_CODEC = "zstd"


def broadcasts(table: DataFrame) -> bool:
    """Whether Spark's own estimate of the table's size allows a broadcast of it."""
    session = table.sparkSession._jsparkSession.sessionState()
    limit = session.conf().autoBroadcastJoinThreshold()
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _words(texts: pa.Array, keep: int | None = None) -> pa.ListArray:
    """Whitespace words (Python's ``split()``) of each text, at most the first ``keep``; a null has none."""
    try:
        blank = pc.utf8_trim_whitespace(texts)
    except pa.ArrowInvalid:  # bytes that aren't UTF-8
        raw = texts.cast(pa.binary()).to_pylist()
        blank = pc.utf8_trim_whitespace(pa.array([t if t is None else t.decode("utf-8", "replace") for t in raw], pa.string()))
    some = pc.replace_with_mask(blank, pc.equal(pc.fill_null(blank, ""), ""), pa.scalar(None, pa.string()))
    if keep is None:
        return pc.utf8_split_whitespace(some)
    if keep == 0:
        return pa.nulls(len(some), pa.list_(pa.string()))
    return pc.list_slice(pc.utf8_split_whitespace(some, max_splits=keep), 0, keep)


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(token, n): whitespace words of a text column, counted in each task; a word may come several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def flush() -> Iterator[pa.RecordBatch]:
            counts = pa.chunked_array(held, pa.string()).value_counts()
            held.clear()
            yield from pa.table({"token": counts.field("values"), "n": counts.field("counts")}).to_batches(max_chunksize=1 << 16)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                held.append(_words(batch.column(0).slice(start, SLICE_ROWS)).flatten())
                if sum(map(len, held)) >= COUNTED:
                    yield from flush()
        if held:
            yield from flush()

    return texts.select(F.col(text_col)).mapInArrow(run, "token string, n long")


class _Packer:
    """Rows of one task as blocks: columns that stay, and per cell a number of places in the dictionary."""

    def __init__(self, stay: Sequence[str], cells: Sequence[str], kind: pa.DataType):
        from pyspark import TaskContext

        self.stay, self.cells, self.kind = list(stay), list(cells), kind
        self.number = TaskContext.get().partitionId() << 32
        self.rows: list[pa.RecordBatch] = []

    def block(self, sizes: list[np.ndarray], places: list[np.ndarray], words: pa.Array) -> pa.RecordBatch:
        held = pa.Table.from_batches(self.rows)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = {"block": pa.array([self.number], pa.int64())}
        for name in self.stay:
            columns[name] = one(held.column(name).combine_chunks())
        for name, n, at in zip(self.cells, sizes, places, strict=True):
            columns[f"{name}_n"] = pa.array([_squeezed(n)], pa.binary())
            columns[f"{name}_at"] = pa.array([_squeezed(at)], pa.binary())
        columns["words"] = one(words.cast(self.kind))
        self.number, self.rows = self.number + 1, []
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _squeezed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed behind their count."""
    raw = np.ascontiguousarray(numbers, "<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, _CODEC, asbytes=True)


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), _CODEC, asbytes=True), "<i4")


def _schema(rows: DataFrame, stay: Sequence[str], cells: Sequence[str], kind: str) -> str:
    types = dict(rows.dtypes)
    parts = ["block long", *[f"`{c}` array<{types[c]}>" for c in stay], *[f"`{c}_n` binary, `{c}_at` binary" for c in cells], f"words array<{kind}>"]
    return ", ".join(parts)


def pack_texts(rows: DataFrame, texts: Sequence[str], keep: int | None) -> DataFrame:
    """Blocks of rows, where the ``texts`` columns become places of their words, at most the first ``keep``."""
    cells, stay = list(texts), [c for c in rows.columns if c not in texts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sizes, held, total = _Packer(stay, cells, pa.string()), [[] for _ in cells], [[] for _ in cells], 0

        def flush() -> pa.RecordBatch:
            coded = pa.chunked_array([w for cell in held for w in cell], pa.string()).combine_chunks().dictionary_encode()
            at = coded.indices.to_numpy()
            cuts = np.cumsum([sum(map(len, cell)) for cell in held])[:-1]
            return packer.block([np.concatenate(n) for n in sizes], np.split(at, cuts), coded.dictionary)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(start, SLICE_ROWS)
                packer.rows.append(some.select(stay))
                for name, n, cell in zip(cells, sizes, held, strict=True):
                    words = _words(some.column(name), keep)
                    n.append(pc.fill_null(words.value_lengths(), 0).to_numpy())
                    cell.append(words.flatten())
                    total += len(cell[-1])
                if total >= BLOCK_WORDS:
                    yield flush()
                    sizes, held, total = [[] for _ in cells], [[] for _ in cells], 0
        if packer.rows:
            yield flush()

    return written(rows.mapInArrow(run, _schema(rows, stay, cells, "string")), "text_blocks")


def pack_ids(rows: DataFrame, ids: str, least: int) -> DataFrame:
    """Blocks of rows, where the ``ids`` arrays become places of their ids; those below ``least`` and nulls are left out."""
    stay = [c for c in rows.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sizes, held, total = _Packer(stay, [ids], pa.int32()), [], [], 0

        def flush() -> pa.RecordBatch:
            words, at = np.unique(np.concatenate(held), return_inverse=True)
            return packer.block([np.concatenate(sizes)], [at], pa.array(words, pa.int32()))

        for batch in batches:
            kept, column, start = batch.select(stay), batch.column(ids), 0
            while start < batch.num_rows:
                some = column.slice(start, SLICE_ROWS)
                lengths = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False)
                values = pc.fill_null(some.flatten(), least - 1).to_numpy(zero_copy_only=False)
                words = values >= least
                row = np.repeat(np.arange(len(some)), lengths)
                sizes.append(np.bincount(row[words], minlength=len(some)))
                held.append(values[words])
                packer.rows.append(kept.slice(start, len(some)))
                start, total = start + len(some), total + len(held[-1])
                if total >= BLOCK_WORDS:
                    yield flush()
                    sizes, held, total = [], [], 0
        if packer.rows:
            yield flush()

    return written(rows.mapInArrow(run, _schema(rows, stay, [ids], "int")), "id_blocks")


def _looked_up(packed: DataFrame, table: DataFrame, on: str, answer: str, stay: Sequence[str], schema: str, fill: Callable) -> DataFrame:
    """Each block's rows, its cells filled by ``fill(block, places, answers)``; words without an answer are not in ``places``."""
    words = packed.select(F.col("block").alias("__of"), F.posexplode("words").alias("__place", "__word"))
    found = words.join(table.select(F.col(on).alias("__word"), F.col(answer).alias("__answer")), "__word").select("__of", "__place", "__answer")

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        places = answers.column("__place").to_numpy()
        columns = {name: block.column(name).combine_chunks().flatten() for name in stay}
        return pa.table(columns | fill(block, places, answers.column("__answer").combine_chunks()))

    # the dictionary has served
    rest = packed.drop("words")
    return rest.groupBy("block").cogroup(found.groupBy("__of")).applyInArrow(run, schema)


def _cell(block: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the rows, places of all their words)."""
    sizes, at = (_numbers(block.column(f"{name}{x}")[0].as_py()) for x in ("_n", "_at"))
    return np.append(0, np.cumsum(sizes)).astype(np.int32), at


def _stay(packed: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of the columns that rows kept."""
    return [(c, t[len("array<") : -1]) for c, t in packed.dtypes if t.startswith("array<") and c != "words"]


def look_up_ids(packed: DataFrame, vocab: DataFrame, unknown: int) -> DataFrame:
    """The rows of ``pack_texts`` with the ids of their words as arrays; words that ``vocab`` lacks are ``unknown``."""
    stay, cells = _stay(packed), [c[: -len("_at")] for c in packed.columns if c.endswith("_at")]

    def fill(block: pa.Table, places: np.ndarray, answers: pa.Array) -> dict[str, pa.Array]:
        cut = {name: _cell(block, name) for name in cells}
        ids = np.full(max((int(at.max()) + 1 for _, at in cut.values() if len(at)), default=0), unknown, np.int32)
        ids[places] = answers.to_numpy(zero_copy_only=False)
        return {name: pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[at])) for name, (offsets, at) in cut.items()}

    schema = ", ".join([*[f"`{c}` {t}" for c, t in stay], *[f"`{c}` array<int>" for c in cells]])
    return _looked_up(packed, vocab, "token", "id", [c for c, _ in stay], schema, fill)


def look_up_tokens(packed: DataFrame, vocab: DataFrame, ids: str) -> DataFrame:
    """The rows of ``pack_ids`` with their words joined by ' '; ids that ``vocab`` lacks are left out."""
    stay = _stay(packed)

    def fill(block: pa.Table, places: np.ndarray, answers: pa.Array) -> dict[str, pa.Array]:
        offsets, at = _cell(block, ids)
        words = dict(zip(places.tolist(), answers.to_pylist(), strict=True))
        texts = [" ".join([words[p] for p in at[a:b].tolist() if p in words]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return {ids: pa.array(texts, pa.string())}

    schema = ", ".join([*[f"`{c}` {t}" for c, t in stay], f"`{ids}` string"])
    return _looked_up(packed, vocab, "id", "token", [c for c, _ in stay], schema, fill)


def except_repeated(packed: DataFrame, out: DataFrame, key: str, df: DataFrame, plain: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``out``, but the rows whose key is there more than once (null is a key) as ``plain`` makes them of ``df``: one for each key."""
    keys = packed.select(F.explode("__key").alias("__again"))
    again = keys.groupBy("__again").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__again")
    if again.isEmpty():
        return out
    again = written(again, "repeated_keys")
    same = F.col(key).eqNullSafe(F.col("__again"))
    return out.join(again, same, "left_anti").unionByName(plain(df.join(again, same, "left_semi")))
