"""Token counts under a unigram model, by dynamic programming shared in a trie.

The pieces of a public vocabulary get log-probabilities by Zipf's law from their rank. The
best segmentation of a pre-token is the path of greatest total score. Distinct pre-tokens
are put into a trie; every node stands for a prefix and holds the best score of reaching it
and the number of tokens on that path, both computed once, however many pre-tokens share the
prefix. The node where a pre-token ends holds its count. A Python worker keeps one trie and
the counts of the pre-tokens it has met, both of bounded size, for all tasks it runs, so
nothing is shuffled and no text leaves its task; counts do not depend on what it keeps.

Defined results: a NULL or empty text has no pre-tokens and 0 tokens. Characters outside
the vocabulary cost one token for each of their UTF-8 bytes. Among segmentations of equal
score the one with fewer tokens counts. Repeated rows are counted each. Texts of any length are
read whole. Other columns are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdgrid.llm.common import WORD_PATTERN, in_slices

# What a pre-token begins with: the mark that the vocabulary uses for a space before a word.
MARK = "▁"
# Nodes that a trie may have, and pre-tokens that keep their count; what is full starts anew.
MOST_NODES = 800_000
MOST_WORDS = 800_000
# Rank from which Zipf's law counts, so that the first pieces are not too likely.
ZIPF_SHIFT = 2.7


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def scores(path: str) -> tuple[dict[str, float], float]:
    """Log-probability of every piece, and that of a single byte.

    Rank is the place among the ordinary pieces by the vocabulary's own score.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    total = sum(1 / (r + ZIPF_SHIFT) for r in range(len(ids)))
    found = {
        model.id_to_piece(i): -log((r + ZIPF_SHIFT) * total) for r, i in enumerate(ids)
    }
    byte = -log((len(ids) + ZIPF_SHIFT) * total) - 1.0
    return found, byte


@lru_cache(maxsize=2)
def endings(path: str) -> dict[str, float | None]:
    """Every ending of a piece with the log-probability it has as a piece itself, if any."""
    pieces = scores(path)[0]
    return {p[i:]: pieces.get(p[i:]) for p in pieces for i in range(len(p))}


class Trie:
    """Prefixes of pre-tokens with their forward scores.

    A node is a number; ``edges`` leads from (node, character) to the next. ``best`` and
    ``tokens`` are the forward values of a node, ``back`` its parent.
    """

    def __init__(self, path: str, most_nodes: int = MOST_NODES) -> None:
        self.endings, self.byte = endings(path), scores(path)[1]
        self.most_nodes = most_nodes
        self.counts: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.edges: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]

    def total(self, words: list[str]) -> int:
        """Tokens of all pre-tokens of a text; every word has at least one."""
        return sum([self.counts.get(w) or self.count(w) for w in words])

    def count(self, word: str) -> int:
        """Tokens of a pre-token that was not met before, stored where it ends."""
        if len(self.best) + len(word) > self.most_nodes:
            self.clear()
        marked, node, path = MARK + word, 0, [0]
        for end, character in enumerate(marked, 1):
            child = self.edges.get((node, character))
            if child is None:
                child = self._grow(node, marked, end, path)
            node = child
            path.append(node)
        if len(self.counts) >= MOST_WORDS:
            self.counts.clear()
        self.counts[word] = self.tokens[node]
        return self.tokens[node]

    def _grow(self, parent: int, marked: str, end: int, path: list[int]) -> int:
        """Add the node of ``marked[:end]``; ``path`` holds the nodes of its prefixes."""
        width = len(marked[end - 1].encode("utf-8", "surrogatepass"))
        best, tokens = self.best[parent] + self.byte * width, self.tokens[parent] + width
        reached, counted, endings_ = self.best, self.tokens, self.endings
        # Only endings of pieces are looked at, from the shortest.
        for start in range(end - 1, -1, -1):
            piece = marked[start:end]
            if piece not in endings_:
                break
            score = endings_[piece]
            if score is not None:
                total, several = reached[path[start]] + score, counted[path[start]] + 1
                if total > best or (total == best and several < tokens):
                    best, tokens = total, several
        node = len(self.best)
        self.edges[parent, marked[end - 1]] = node
        self.best.append(best)
        self.tokens.append(tokens)
        return node


@lru_cache(maxsize=2)
def shared(path: str, most_nodes: int) -> Trie:
    """One trie for all tasks of a Python worker."""
    return Trie(path, most_nodes)


def count_tokens(
    docs: DataFrame, vocabulary: str | None = None, most_nodes: int = MOST_NODES
) -> DataFrame:
    """doc_id, n_pretokens, n_distinct_pretokens and n_tokens of every row."""
    path = vocabulary or default_vocabulary()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared(path, most_nodes)
        for batch in in_slices(batches):
            all_, distinct, tokens = [], [], []
            for text in batch.column("text"):
                words = WORD_PATTERN.findall(text.as_py() or "")
                all_.append(len(words))
                distinct.append(len(set(words)))
                tokens.append(trie.total(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (all_, distinct, tokens))],
                names=["doc_id", "n_pretokens", "n_distinct_pretokens", "n_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        counted, "doc_id long, n_pretokens long, n_distinct_pretokens long, n_tokens long"
    )
