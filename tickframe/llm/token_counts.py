"""Token counts by trie-shared dynamic programming.

Each task inserts the distinct pre-tokens that it has not met before into a trie, in sorted order, so that words
with a common prefix follow each other and the path of the last word down to the common prefix is still there. A
node holds the unigram forward score of its prefix (the best score of any segmentation) and the number of tokens on
that path; both need only the nodes above, so a prefix that words share is scored once. A word's count is stored
with its terminal node and read from there whenever the word comes again. Ties go to the longest last piece.

Nodes off the current path are never needed again, so only the path and the terminals are kept; terminals are
emptied when there are max_words of them, which bounds memory and changes no result. There is no shuffle; a lost
task is run again. Null or empty text has no pre-tokens and no tokens; a very long word costs time in proportion to
its length. Rows are treated one by one, further columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from tickframe.llm.unigram import Vocabulary, pretokens


class Trie:
    def __init__(self, vocabulary: Vocabulary, max_words: int = 1_000_000):
        self.max_words, self.unknown, self.byte_count = max_words, vocabulary.unknown, vocabulary.byte_count
        self.terminal: dict[str, int] = {}
        self.scored = 0
        #: Pieces by their characters from the last to the first; "" leads to a piece's score.
        self.endings: dict = {}
        for piece, (_, score) in vocabulary.pieces.items():
            node = self.endings
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[""] = score

    def insert(self, words: list[str]) -> None:
        """Store the token counts of words, which are in sorted order."""
        score, count, last = [0], [0], ""
        endings, unknown, terminal = self.endings, self.unknown, self.terminal
        for word in words:
            shared, limit = 0, min(len(last), len(word))
            while shared < limit and last[shared] == word[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for j in range(shared, len(word)):
                best, tokens, i, node = None, 0, j, endings
                single = False
                while i >= 0:
                    node = node.get(word[i])
                    if node is None:
                        break
                    piece = node.get("")
                    if piece is not None:
                        single |= i == j
                        x = score[i] + piece
                        if best is None or x >= best:
                            best, tokens = x, count[i] + 1
                    i -= 1
                if not single:  # spelt in bytes, at a low score
                    x = score[j] + unknown
                    if best is None or x > best:
                        best, tokens = x, count[j] + self.byte_count(word[j])
                score.append(best)
                count.append(tokens)
            self.scored += len(word) - shared
            terminal[word] = count[-1]
            last = word

    def tokens(self, texts: list[list[str]]) -> list[int]:
        """The number of tokens of each list of pre-tokens."""
        if len(self.terminal) > self.max_words:
            self.terminal.clear()
        new = set().union(*texts).difference(self.terminal)
        self.insert(sorted(new))
        get = self.terminal.__getitem__
        return [sum(map(get, words)) for words in texts]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, max_words: int = 1_000_000, at_once: int = 2_000_000) -> DataFrame:
    """id_col, n_pretokens long, n_tokens long, one row per input row. at_once: characters of text read at a time."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        trie = Trie(Vocabulary(model), max_words)
        for b in batches:
            words, tokens, held, size = [], [], [], 0
            for text in b.column(1):
                parts = pretokens(text.as_py())
                words.append(len(parts))
                held.append(parts)
                size += sum(map(len, parts))
                if size >= at_once:
                    tokens += trie.tokens(held)
                    held, size = [], 0
            tokens += trie.tokens(held)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["id", "n_pretokens", "n_tokens"])

    out = docs.select(docs[id_col], docs[text_col]).mapInArrow(run, f"id {id_type}, n_pretokens long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
