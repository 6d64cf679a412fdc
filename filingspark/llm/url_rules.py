"""Operator 4: glob rules over URLs, all simulated at once by a bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 4096


@dataclass(frozen=True)
class Rule:
    """A glob over the canonical URL, what it decides, and the name it is reported by.

    The canonical URL is ``.host/path?query``. ``*`` stands for any run, ``?`` for any
    one byte, a backslash takes the next byte as it is. Before the first ``/`` or ``\\?``
    of the glob both stay inside the host. A glob must fit the whole URL.
    """

    glob: str
    verdict: str
    name: str | None = None

    @staticmethod
    def of_host(host: str, path: str, verdict: str) -> Rule:
        """Fits ``host`` and its subdomains where the URL's path starts with ``path``."""
        plain = "".join("\\" + c if c in "*?\\" else c for c in host + path)
        return Rule(f"*.{plain}*", verdict, host + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    """``?`` and what follows it up to ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)


def _rest(url: Column) -> Column:
    after = F.locate("://", url)
    return F.when(after > 0, F.expr("substr(_url, locate('://', _url) + 3)")).otherwise(F.lit(""))


class Automaton:
    """Shift-And over many globs at once.

    Each glob owns a run of bits over as many 64-bit words as needed: one start bit
    and one bit per byte that it consumes. Reading a byte shifts all states, keeps
    those whose byte fits, and keeps states with a ``*`` behind them where they are.
    Any of the bytes ``ends`` ends the host.
    """

    def __init__(self, globs: Sequence[str], ends: bytes = b"/"):
        starts, finals, steps, loops = [], [], [], []
        bit = 0
        for glob in globs:
            starts.append(bit)
            in_host, quoted = True, False
            for c in glob.encode():
                if not quoted and c == ord("\\"):
                    quoted = True
                    continue
                kind = "byte" if quoted else {ord("*"): "run", ord("?"): "any"}.get(c, "byte")
                quoted = False
                if kind == "run":
                    loops.append((bit, in_host))
                    continue
                bit += 1
                steps.append((bit, c if kind == "byte" else None, in_host))
                if kind == "byte" and c in ends:
                    in_host = False
            finals.append(bit)
            bit += 1
        self.words = bit // 64 + 1
        self.step = np.zeros((256, self.words), dtype=np.uint64)
        self.loop = np.zeros((256, self.words), dtype=np.uint64)
        for at, byte, in_host in steps:
            self._allow(self.step, at, byte, ends if in_host else b"")
        for at, in_host in loops:
            self._allow(self.loop, at, None, ends if in_host else b"")
        self.start = np.zeros(self.words, dtype=np.uint64)
        for at in starts:
            self.start[at // 64] |= np.uint64(1 << at % 64)
        self.finals = finals

    @staticmethod
    def _allow(masks: np.ndarray, at: int, byte: int | None, but: bytes) -> None:
        flag = np.uint64(1 << at % 64)
        if byte is not None:
            masks[byte, at // 64] |= flag
            return
        masks[:, at // 64] |= flag
        masks[[*but], at // 64] &= ~flag

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``[text, glob]`` for texts held end to end in ``data``."""
        count = len(offsets) - 1
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        state = np.repeat(self.start[None, :], count, axis=0)
        begin, length = offsets[:-1][order], lengths[order]
        one, top = np.uint64(1), np.uint64(63)
        live = count
        for at in range(int(length[0]) if count else 0):
            while live and length[live - 1] <= at:
                live -= 1
            read = data[begin[:live] + at]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[read]) | (now & self.loop[read])
        found = np.empty((count, len(self.finals)), dtype=bool)
        for i, at in enumerate(self.finals):
            found[order, i] = (state[:, at // 64] >> np.uint64(at % 64)) & one != 0
        return found


def judge(pages: DataFrame, url: str, rules: Sequence[Rule], otherwise: str = "allow") -> DataFrame:
    """Adds ``host, path, rule, verdict, globs`` to each row.

    Named rules come first: the longest name that fits decides (``block`` before
    ``allow`` among equals, then the order given). Where none fits, a fitting unnamed
    glob decides, ``block`` before ``allow``; else ``otherwise``. ``globs`` lists all
    globs that fit. A NULL URL, or one without ``://``, has an empty host and path.
    URLs are read whole, whatever their length; columns with these names are replaced.
    """
    ranked = sorted(
        range(len(rules)),
        key=lambda i: (rules[i].name is None, -len(rules[i].name or ""), rules[i].verdict != "block", i),
    )
    automaton = Automaton([rules[i].glob for i in ranked], ends=b"/?")
    names = np.array([rules[i].name for i in ranked], dtype=object)
    verdicts = np.array([rules[i].verdict for i in ranked], dtype=object)
    globs = [rules[i].glob for i in ranked]
    added = ["host", "path", "rule", "verdict", "globs"]
    kept = [c for c in pages.columns if c not in added]
    parts = pages.select(*kept).withColumn("_url", F.col(url))
    parts = parts.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    parts = parts.withColumn("_canonical", F.concat(F.lit("."), "host", "path", query_of(F.col("_url"))))
    parts = parts.withColumn("_canonical", F.when(F.instr("_url", "://") > 0, F.col("_canonical"))).drop("_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(first, CHUNK)
                texts = [(t or "").encode() for t in batch.column("_canonical").to_pylist()]
                data = np.frombuffer(b"".join(texts) or b"\0", dtype=np.uint8)
                offsets = np.cumsum([0, *map(len, texts)])
                fits = automaton.match(data, offsets)
                hit = fits.any(axis=1)
                top = fits.argmax(axis=1)
                rule = [names[i] if h else None for i, h in zip(top, hit)]
                verdict = [verdicts[i] if h else otherwise for i, h in zip(top, hit)]
                found = [[globs[j] for j in np.flatnonzero(row)] for row in fits]
                columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_canonical"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string()),
                     pa.array(found, pa.list_(pa.string()))],
                    names=[*[n for n in batch.schema.names if n != "_canonical"], "rule", "verdict", "globs"],
                )

    schema = T.StructType(
        [f for f in parts.schema.fields if f.name != "_canonical"]
        + [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()),
           T.StructField("globs", T.ArrayType(T.StringType()))]
    )
    return parts.mapInArrow(run, schema)
