"""Token counts under a unigram vocabulary, by dynamic programming shared in a trie.

Texts fall into pre-tokens, none of which a piece crosses. The distinct pre-tokens of a batch
form a trie, whose nodes have the best score of any segmentation that ends there, with its
number of tokens. A node's score depends on the characters above it only, so a prefix that many
pre-tokens share is computed once. The trie is grown in sorted order, where a finished branch is
never entered again: only the nodes on the path to the present one are held, and the counts of
the terminal ones.
"""

import gc
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from gabarito.llm.common import append_columns

MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNKNOWN_PENALTY = 10.0  # below the worst piece, as the library has it
REMEMBERED = 200_000  # terminal counts in each of a task's two memories
FIELDS = [StructField("n_pretokens", LongType()), StructField("n_tokens", LongType())]


class Unigram:
    """Pieces with their scores, and how a character without a piece is counted."""

    def __init__(self, model: bytes):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        scores = {}
        self.has_bytes = False
        for i in range(lib.get_piece_size()):
            if lib.is_byte(i):
                self.has_bytes = True
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                scores[lib.id_to_piece(i)] = lib.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("a piece has a word mark after another character")
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        # A trie of the pieces: characters lead on, and "" gives the score of a whole piece.
        self.pieces: dict = {}
        for piece, score in scores.items():
            node = self.pieces
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = score

    def unknown_tokens(self, character: str) -> int:
        return len(character.encode()) if self.has_bytes else 1


class Trie:
    """The trie of distinct pre-tokens, and the terminal counts of those met lately."""

    def __init__(self, model: Unigram):
        self.model = model
        self.terminal: dict[str, int] = {}
        self.terminal_before: dict[str, int] = {}

    def insert(self, words: list[str]) -> None:
        """Terminal counts of `words`, which must be sorted."""
        pieces, unknown = self.model.pieces, self.model.unknown
        # A node of the path: its score and tokens, and the pieces begun above it that may go on,
        # each with the score and tokens where it began, the earliest first.
        path: list[tuple[float, int, list]] = [(0.0, 0, [])]
        last = ""
        for word in words:
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del path[shared + 1 :]
            for character in word[shared:]:
                score, tokens, begun = path[-1]
                best, count, going_on = None, 0, []
                for node, before, tokens_before in (*begun, (pieces, score, tokens)):
                    following = node.get(character)
                    if following is not None:
                        going_on.append((following, before, tokens_before))
                        piece = following.get("")
                        # Of equal scores the longest last piece wins.
                        if piece is not None and (best is None or before + piece > best):
                            best, count = before + piece, tokens_before + 1
                alone = pieces.get(character)
                if (alone is None or "" not in alone) and (best is None or score + unknown > best):
                    best, count = score + unknown, tokens + self.model.unknown_tokens(character)
                path.append((best, count, going_on))
            self.terminal[word] = path[-1][1]
            last = word

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of every whole text."""
        split = [PRE_TOKEN.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.terminal) > REMEMBERED:
            self.terminal, self.terminal_before = {}, self.terminal
        terminal, before, fresh = self.terminal, self.terminal_before.get, []
        for word in {w for words in split for w in words}:
            if word not in terminal:
                found = before(word)
                if found is None:
                    fresh.append(word)
                else:
                    terminal[word] = found
        self.insert(sorted(fresh))
        return [(len(words), sum(map(terminal.__getitem__, words))) for words in split]


def count_tokens(df: DataFrame, model_path: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """`df` with `n_pretokens` and `n_tokens` of every whole text.

    Scores of the vocabulary are log weights whatever kind of model it was made for; a
    character without a piece counts its UTF-8 bytes when the vocabulary has byte pieces, else
    one. Null and empty texts count 0. Repeated rows stay; columns named like a result give
    way; an empty table gives no rows. The model file is read once here and sent to the tasks.
    """
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())

    def start() -> Callable[[list], list]:
        trie = Trie(Unigram(model.value))  # a task's own: idle workers hold no words

        def compute(texts: list) -> list:
            # Nothing here is cyclic, and the collector would walk the trie again and again.
            gc.disable()
            try:
                return [list(c) for c in zip(*trie.count([t or "" for t in texts]))]
            finally:
                gc.enable()

        return compute

    return append_columns(df, text_col, FIELDS, start, keep_text)
