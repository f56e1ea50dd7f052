"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding is the score-ordered agenda: all adjacent symbol pairs whose join is in the vocabulary
wait in a heap, the best score (then the leftmost) is merged first, and a merge offers its two
new neighbours. As no entry of the vocabulary has a word mark after another character, a merge
never crosses into the next word, so words are encoded on their own and remembered. Where no
entry has another character after a letter either, words are cut there, too.
"""

import gc
import heapq
import re
from collections.abc import Callable
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from gabarito.llm.common import append_columns

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
# The same, cut after each run of Latin letters as well.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
LETTERS_END = re.compile(f"[{LETTERS}][^{LETTERS}{MARK}]")
SHORT_WORD = re.compile(f"{MARK}*[^{LETTERS}{MARK}]*[{LETTERS}]+|{MARK}*[^{LETTERS}{MARK}]+|{MARK}+")
REMEMBERED = 250_000  # words in each of a task's two memories
SHORT = 48
NEVER = 1 << 60
PLACE_BITS = 40
PLACES = (1 << PLACE_BITS) - 1


class MergeVocabulary:
    """Pieces and scores of a SentencePiece model, as far as a merge-type encoder needs them."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        self.scores, self.ids, self.bytes = {}, {}, {}
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif lib.is_unused(i):
                raise ValueError("unused pieces are not supported")
            elif not lib.is_control(i) and not lib.is_unknown(i):
                self.scores[piece], self.ids[piece] = lib.get_score(i), i
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece has a word mark after another character")
        self.unknown = lib.unk_id()
        self.word = WORD if any(map(LETTERS_END.search, self.scores)) else SHORT_WORD
        order = {score: n for n, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in self.scores.items()}

    def merge_short(self, part: str) -> list[str]:
        """The agenda as a plain list of ranks by place: its least entry, the leftmost of equals, is merged."""
        symbols, rank_of = list(part), self.ranks.get
        agenda = [rank_of(part[i : i + 2], NEVER) for i in range(len(part) - 1)]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            joined = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank_of(joined + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = rank_of(symbols[i - 1] + joined, NEVER)
        return symbols

    def merge_long(self, part: str) -> list[str]:
        """The agenda as a heap of (rank, place), for parts where a scan for the least would be slow."""
        symbols, size, ranks = list(part), len(part), self.ranks
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        pending = [-1] * (size + 1)  # rank of the pair that now starts at a place
        agenda = []
        for i in range(size - 1):
            rank = ranks.get(part[i : i + 2], -1)
            if rank >= 0:
                pending[i] = rank
                agenda.append(rank << PLACE_BITS | i)
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & PLACES
            if pending[left] != entry >> PLACE_BITS:
                continue  # one of its symbols was merged meanwhile
            right = after[left]
            joined = symbols[left] = symbols[left] + symbols[right]
            pending[left] = pending[right] = -1
            following = after[left] = after[right]
            if following < size:
                before[following] = left
                rank = ranks.get(joined + symbols[following], -1)
                if rank >= 0:
                    pending[left] = rank
                    heapq.heappush(agenda, rank << PLACE_BITS | left)
            previous = before[left]
            if previous >= 0:
                rank = pending[previous] = ranks.get(symbols[previous] + joined, -1)
                if rank >= 0:
                    heapq.heappush(agenda, rank << PLACE_BITS | previous)
        out, place = [], 0
        while place < size:
            out.append(symbols[place])
            place = after[place]
        return out

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of the symbols that remain; one without an id is spelled in bytes."""
        symbols = self.merge_short(word) if len(word) <= SHORT else self.merge_long(word)
        try:
            return tuple([self.ids[s] for s in symbols])
        except KeyError:
            return tuple([i for s in symbols for i in self.spelled(s)])

    def spelled(self, symbol: str) -> list[int]:
        if symbol in self.ids:
            return [self.ids[symbol]]
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.unknown]


class Encoder:
    """Encodes whole texts; a word is encoded when it is new.

    With `check`, new words that begin with a mark are compared with the library in batches, and
    so is the first whole text of each batch.
    """

    def __init__(self, model: bytes, check: bool = True):
        self.vocabulary = MergeVocabulary(model)
        self.check = check
        # What was met lately, and what was met before that: a full memory becomes the older one.
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_before: dict[str, tuple[int, ...]] = {}

    def learn(self, words: set[str]) -> None:
        """Encode the new words and compare them with the library."""
        if len(self.known) > REMEMBERED:
            self.known, self.known_before = {}, self.known
        known, before, fresh = self.known, self.known_before.get, []
        for word in words:
            if word not in known:
                found = before(word)
                if found is None:
                    fresh.append(word)
                    found = self.vocabulary.encode_word(word)
                known[word] = found
        if self.check:
            # The library puts one mark before a text; a word's own first mark stands for it.
            own = [w for w in fresh if w[0] == MARK and w != MARK]
            for word, ids in zip(own, self.vocabulary.library.encode([w[1:] for w in own], num_threads=1)):
                if tuple(ids) != known[word]:
                    raise ValueError(f"agenda and library differ on {word!r}: {known[word]} / {ids}")

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = self.vocabulary.word.findall
        words = [cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn({w for ws in words for w in ws})
        ids_of = self.known.__getitem__
        out = [list(chain.from_iterable(map(ids_of, ws))) for ws in words]
        if self.check and texts and self.vocabulary.library.encode(texts[0]) != out[0]:
            raise ValueError(f"agenda and library differ on a text that begins {texts[0][:80]!r}")
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.vocabulary.library.decode(ids) if ids else []


def encode_texts(
    df: DataFrame,
    model_path: str,
    text_col: str = "text",
    check: bool = True,
    keep_text: bool = True,
) -> DataFrame:
    """`df` with `ids` array<int> and `decoded` string, the library's encode() and decode().

    Null texts count as empty: no ids, empty decoded text. Texts of any length are encoded
    whole. Repeated rows stay. Columns named `ids` or `decoded` give way. An empty table gives
    no rows. With `check`, the distinct words that a task meets after a blank, and a whole text
    of each batch, are also encoded by the library, and a difference fails the job. The model must be merge-type without unused
    pieces; its file is read once here and sent to the tasks.
    """
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())

    def start() -> Callable[[list], list]:
        encoder = Encoder(model.value, check)  # a task's own: idle workers hold no words

        def compute(texts: list) -> list:
            # Nothing here is cyclic, and the collector would walk the remembered words again and again.
            gc.disable()
            try:
                ids = encoder.encode([t or "" for t in texts])
                return [ids, encoder.decode(ids)]
            finally:
                gc.enable()

        return compute

    fields = [StructField("ids", ArrayType(IntegerType(), False)), StructField("decoded", StringType())]
    return append_columns(df, text_col, fields, start, keep_text)
