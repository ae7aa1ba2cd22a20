"""Token counts under a unigram model, by dynamic programming shared in a trie.

A text is cut into words, each led by the piece vocabulary's word mark.  The
unigram segmentation of a word is the split into pieces of highest total
log-probability (fewer pieces on ties).  Its forward scores at a prefix depend
on the prefix alone, so the distinct words of a batch of documents go into a
trie and each trie node is scored once, however many words pass through it;
terminal nodes give the words' token counts.  The trie is walked in sorted
word order with the scores of the current path on a stack, which is a
depth-first walk of it without building nodes.

Everything happens where the text is read: nothing is shuffled.  A task holds
the counts of at most ``KNOWN`` words and starts anew beyond it (the counts
are the same either way).

The vocabulary is a public sentencepiece file, never trained here.  Its pieces
stand in order of rank; a piece of rank r gets log-probability -log(r + 2.7)
(Zipf's law).  A character in no piece counts one token per UTF-8 byte.

Defined results: a null, empty or blank text has 0 words and 0 tokens; a very
long word is linear in its length; repeated rows count separately; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # leads every word in the piece vocabulary
KNOWN = 400_000
BYTE_SCORE = -20.0


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_scores(path: str) -> dict[str, float]:
    """Log-probability of every ordinary piece, by its rank in the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [k for k in range(model.get_piece_size())
           if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    return {model.id_to_piece(k): -math.log(rank + 2.7) for rank, k in enumerate(ids)}


def count_words(distinct: Iterable[str], scores: dict[str, float], longest: int) -> dict[str, int]:
    """Token count of every word: one forward step per trie node.

    ``best[d]`` is the (score, -tokens) of the best split of the current
    path's first d characters.
    """
    counts: dict[str, int] = {}
    best: list[tuple[float, int]] = [(0.0, 0)]
    path = ""
    for word in sorted(distinct):
        text = MARK + word
        shared = 0
        for a, b in zip(path, text):
            if a != b:
                break
            shared += 1
        del best[shared + 1:]
        for end in range(shared + 1, len(text) + 1):
            top = None
            for start in range(max(0, end - longest), end):
                score = scores.get(text[start:end])
                if score is not None:
                    reached, tokens = best[start]
                    way = (reached + score, tokens - 1)
                    if top is None or way > top:
                        top = way
            if text[end - 1] not in scores:
                reached, tokens = best[end - 1]
                size = len(text[end - 1].encode())
                way = (reached + BYTE_SCORE * size, tokens - size)
                if top is None or way > top:
                    top = way
            best.append(top)
        path = text
        counts[word] = -best[-1][1]
    return counts


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens of every document."""
    path = path or vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = unigram_scores(path)
        longest = max(map(len, scores), default=1)
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1)]
            at = 0
            n_words, n_tokens = [], []
            while at < len(texts):  # as many documents at once as the limit on words allows
                split, new, total = [], set(), 0
                while at < len(texts) and total < KNOWN:
                    split.append(texts[at].split())
                    new.update(split[-1])
                    total += len(split[-1])
                    at += 1
                if len(known) > KNOWN:
                    known = {}
                new.difference_update(known)
                names = {w.decode(): w for w in new}
                known.update((names[w], n) for w, n in count_words(names, scores, longest).items())
                for words in split:
                    n_words.append(len(words))
                    n_tokens.append(sum(map(known.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        count, "doc_id long, n_words long, n_tokens long")
