"""Operator 1: token counts by heap-and-linked-list byte-pair merging.

The count of a text is the number of its initial symbols minus the number of
merges; no identifier is ever produced. The scores come from a public
SentencePiece BPE model (its path is a parameter); the library is used to
read the vocabulary only.

Merging never crosses a place that no vocabulary piece spans, so a text is
cut there first (before a space mark that follows another character, and
around line breaks when no piece holds one) and every distinct part is merged
once per Python worker, in a bounded memo. The rule is derived from the
loaded vocabulary, not assumed.

Cases: null and empty texts have 0 tokens; a character without a piece counts
its UTF-8 bytes (byte fallback) and never merges; repeated rows are counted
separately; columns that clash with the outputs are not carried over; an empty table gives an empty result. Executors
need the vocabulary file at the same path.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
MEMO = 250_000  # parts remembered per generation and Python worker


class Merger:
    """Counts the tokens of a text under one vocabulary."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ordinary = [i for i in range(model.get_piece_size())
                    if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.cost = {model.id_to_piece(i): -model.get_score(i) for i in ordinary}
        inner = [p for p in self.cost if len(p) > 1]
        spans_space = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in inner)
        spans_line = any("\n" in p for p in inner)
        if spans_space:
            self.parts = re.compile("(?s).+")
        elif spans_line:
            self.parts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        else:
            self.parts = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merge(self, part: str) -> int:
        """Tokens of one part: symbols minus merges. The heap holds adjacent
        pairs by (cost, position); a linked list joins the live symbols."""
        cost = self.cost
        n = len(part)
        live = list(part)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        symbols = sum(1 if c in cost else len(c.encode("utf-8", "replace")) for c in part)
        heap = []
        for i in range(n - 1):
            pair = part[i:i + 2]
            if pair in cost:
                heap.append((cost[pair], i, pair))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = live[i]
            if left is None:
                continue
            j = after[i]
            # the entry is stale once either side has grown or gone
            if j >= n or len(left) + len(live[j]) != len(pair) or left + live[j] != pair:
                continue
            merges += 1
            live[i], live[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                joined = pair + live[k]
                if joined in cost:
                    heapq.heappush(heap, (cost[joined], i, joined))
            b = before[i]
            if b >= 0:
                joined = live[b] + pair
                if joined in cost:
                    heapq.heappush(heap, (cost[joined], b, joined))
        return symbols - merges

    def _remember(self, part: str) -> int:
        n = self.old.get(part)
        if n is None:
            n = self.merge(part)
        if len(part) <= 64:
            if len(self.young) >= MEMO:
                self.old, self.young = self.young, {}
            self.young[part] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        for part in self.parts.findall(SPACE + text.replace(" ", SPACE)):
            n = self.young.get(part)
            total += self._remember(part) if n is None else n
        return total


_MERGERS: dict[str, Merger] = {}


def merger(model_path: str) -> Merger:
    if model_path not in _MERGERS:
        _MERGERS[model_path] = Merger(model_path)
    return _MERGERS[model_path]


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``df``, whole texts."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merger(model_path).count
        for b in batches:
            col = b.column("text")
            n_tokens = [count(t.as_py()) for t in col]
            n_bytes = pa.compute.fill_null(pa.compute.binary_length(col), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), n_bytes, pa.array(n_tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    id_type = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
