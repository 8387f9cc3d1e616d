"""Token counts by a unigram model, computed once per shared prefix of words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.shingles import texts
from adstream.llm.workercache import worker_cached

_MAX_NODES = 200_000
_MAX_WORDS = 1_500_000
_SCALE = 1_000_000
WORD_START = "▁"


def public_pieces() -> str:
    """Place of the public 32k piece vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_costs(path: str) -> dict[str, int]:
    """A cost per piece: the negative log probability by Zipf's law of its rank, in millionths.

    The vocabulary has no unigram probabilities, only an order; whole numbers make ties exact.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (rank + 1) for rank in range(len(plain))))
    return {
        model.id_to_piece(i): round(_SCALE * (math.log(rank + 1) + total)) for rank, i in enumerate(plain)
    }


class PrefixTrie:
    """Words share nodes for their prefixes; a node holds its prefix's best segmentation.

    Best is the least cost and then the fewest tokens. A character that is no piece
    counts one token per byte, each costlier than any piece.
    """

    def __init__(self, costs: dict[str, int]):
        self.costs = costs
        self.longest = max(map(len, costs), default=1)
        self.byte_cost = max(costs.values(), default=0) + _SCALE
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.best: list[tuple[int, int]] = [(0, 0)]
        self.terminals: dict[int, int] = {}

    def count(self, word: str) -> int:
        if len(self.best) > _MAX_NODES:
            self.clear()
        node, path, end = 0, [(0, 0)], 0
        children, best, costs, longest = self.children, self.best, self.costs, self.longest
        keep = len(best) + len(word) <= 2 * _MAX_NODES
        for end, char in enumerate(word, 1):
            after = children[node].get(char) if node >= 0 else None
            if after is not None:
                node = after
                path.append(best[node])
                continue
            before = path[end - 1]
            if char in costs:
                found = (before[0] + costs[char], before[1] + 1)
            else:
                n = len(char.encode())
                found = (before[0] + n * self.byte_cost, before[1] + n)
            for start in range(max(0, end - longest), end - 1):
                cost = costs.get(word[start:end])
                if cost is not None:
                    earlier = path[start]
                    candidate = (earlier[0] + cost, earlier[1] + 1)
                    if candidate < found:
                        found = candidate
            path.append(found)
            if keep:
                children[node][char] = node = len(best)
                children.append({})
                best.append(found)
            else:
                node = -1
        if keep:
            self.terminals[node] = path[end][1]
        return path[end][1]


def _counts(path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or public_pieces()
        trie = worker_cached(("trie", file), lambda: PrefixTrie(load_costs(file)))
        known = worker_cached(("token counts", file), dict)
        for batch in batches:
            split = [t.split() if t else [] for t in texts(batch.column(0))]
            # In order, words of one prefix follow each other and find its nodes.
            for word in sorted(set().union(*split).difference(known)):
                known[word] = trie.count(WORD_START + word.decode())
            yield pa.record_batch(
                [
                    pa.array([len(words) for words in split], pa.int64()),
                    pa.array([sum(map(known.__getitem__, words)) for words in split], pa.int64()),
                    *batch.columns[1:],
                ],
                names=["n_words", "n_tokens", *batch.schema.names[1:]],
            )
            if len(known) > _MAX_WORDS:
                known.clear()

    return run


def count_tokens(
    docs: DataFrame, text_col: str = "text", columns: list[str] | None = None, vocabulary: str | None = None
) -> DataFrame:
    """Adds ``n_words`` and ``n_tokens`` to every row of ``docs`` (or to ``columns`` of it).

    Pre-tokens are runs of anything but ASCII white space, with a word-start mark
    before each. Each task inserts the distinct pre-tokens of a batch into a trie and
    runs the forward pass once per new node; words of one prefix share its scores. The
    trie and the word table are emptied at a fixed size, which changes no result. No
    row leaves its task. A NULL or empty text has no tokens; a text of any length is
    counted whole; repeated rows count each; columns named like the new ones give way.
    """
    columns = docs.columns if columns is None else columns
    columns = [c for c in columns if c not in ("n_words", "n_tokens")]
    rows = docs.select(F.col(text_col).cast("string").alias("_body"), *columns)
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    counted = rows.mapInArrow(_counts(vocabulary), f"n_words long, n_tokens long{kept}")
    return counted.select(*columns, "n_words", "n_tokens")
