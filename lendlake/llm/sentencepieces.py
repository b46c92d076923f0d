"""Exact SentencePiece encoding of the merge type by backtracking, and decoding (op11).

A merge-type encoder joins the best neighbouring pair of pieces until none is
left. A sequence of pieces is its result exactly if every two neighbours, merged
on their own, come out as these two again; so each prefix of a text has one
valid sequence. ``Model.encode_part`` looks for it from the left: an
Aho-Corasick automaton over the pieces gives the longest match, the pair with
the piece before is re-merged (and remembered), shorter pieces follow where it
fails, and a bitfield keeps the positions that lead nowhere, so no position
is tried twice and the time is linear in the text.

Texts are normalised by the model's own rules and cut where no piece of the
vocabulary can reach across: before a space mark that follows another
character. Parts repeat, so their results are remembered in a bounded table.
Characters that no piece has become bytes (or the unknown id). Documents are
worked on where Spark puts them; nothing is shuffled or broadcast.

Cases: a null or empty text has no ids and decodes to the empty text; a row
without doc_id is encoded like any other; repeated rows and ids give a row
each; an empty table gives no rows; other columns are ignored. The model's path
is a parameter and must exist on the workers; models of another type, or with
unused or user-defined pieces, raise an error.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from lendlake.llm.tables import id_text, map_rows

MODEL = "piece_bpe_32k.model"
SPACE = "▁"  # stands for a space inside pieces
REPLACEMENT = "�"

#: Entries that the tables of parts and of checked pairs hold before they are begun
#: anew (of parts, the full table before it is kept too).
PARTS, PAIRS = 1 << 18, 1 << 19

_BPE = 2  # the model type of merges in a model file
_NORMAL = 1  # the type of an ordinary piece
_SURFACE = 44  # field: the text that the unknown id decodes to


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, message[at : at + size]
        at += size


class Model:
    """The pieces of a model file, and the tables made from them."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            whole = f.read()
        trainer: dict = {}
        for number, value in _fields(whole):
            if number == 2:
                trainer = dict(_fields(value))
            elif number == 1 and dict(_fields(value)).get(3, _NORMAL) in (4, 5):
                raise ValueError(f"{path}: user-defined or unused pieces are not supported")
        if trainer.get(3, 1) != _BPE:
            raise ValueError(f"{path}: not a model of the merge type")
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = library.normalize
        self.leading = library.normalize("x").startswith(SPACE)
        self.squeezed = library.normalize(" x  x ").strip(SPACE) == f"x{SPACE}x"
        self.plain = not self.squeezed and library.normalize("ﬁ 　x \t") == (
            SPACE * self.leading + f"ﬁ{SPACE}　x \t"
        )
        self.unknown = library.unk_id()
        self.unknown_text = trainer[_SURFACE].decode() if _SURFACE in trainer else " ⁇ "
        n = library.get_piece_size()
        self.piece = [library.id_to_piece(i) for i in range(n)]
        self.control = [library.is_control(i) for i in range(n)]
        self.byte = {int(self.piece[i][1:-1], 16): i for i in range(n) if library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        odd = {*self.byte_of, self.unknown, *(i for i in range(n) if self.control[i])}
        self.id = {p: i for i, p in enumerate(self.piece) if i not in odd}
        self.score = {p: library.get_score(i) for p, i in self.id.items()}
        self.ordinary = set(self.id.values())
        self.surface = [p.replace(SPACE, " ") for p in self.piece]
        self.decimal = [str(i) for i in range(n)]
        self.length = [len(p) for p in self.piece]
        #: Pieces that merging makes out of their own characters; no others occur.
        made = {p: i for p, i in self.id.items() if len(p) == 1 or self.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p, i in made.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        #: The longest made piece that a piece begins with, -1 for none.
        self.shorter = [-1] * n
        for p, i in made.items():
            ends = (p[:k] for k in range(len(p) - 1, 0, -1))
            self.shorter[i] = next((made[q] for q in ends if q in made), -1)
        self.widest = max(map(len, made))
        self.known = {p for p in made if len(p) == 1}
        if set("".join(made)) - self.known:
            raise ValueError(f"{path}: a piece has a character that is no piece itself")
        crossing = [p for p in made if SPACE in p.lstrip(SPACE)]
        self.parts_of = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if not crossing else "(?s).+").findall
        self.unknown_run = re.compile(f"([^{re.escape(''.join(sorted(self.known)))}]+)").split
        self.pairs: dict[int, bool] = {}
        self.recent: dict[str, tuple[int, str, str]] = {}
        self.earlier: dict[str, tuple[int, str, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging: the pair of best score joins first, of equal ones the
        leftmost. Used for short texts only."""
        symbols = list(text)
        score = self.score.get
        while len(symbols) > 1:
            scores = [score(a + b, -1e38) for a, b in zip(symbols, symbols[1:])]
            best = max(scores)
            if best == -1e38:
                break
            k = scores.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def fits(self, a: int, b: int) -> bool:
        """Whether pieces ``a`` and ``b`` stay apart when merged on their own."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            left, right = self.piece[a], self.piece[b]
            known = self.pairs[key] = self.merge(left + right) == [left, right]
        return known

    def encode_part(self, text: str) -> list[int]:
        """The ids of a text of known characters."""
        length, checked, matches = self.length, self.pairs.get, self.automaton.iter_long
        tokens: list[int] = []
        at, last = 0, -1
        for _, token in matches(text):  # longest matches, as long as they fit
            if last >= 0:
                fit = checked(last << 32 | token)
                if not (self.fits(last, token) if fit is None else fit):
                    break
            tokens.append(token)
            at += length[token]
            last = token
        else:
            return tokens
        shorter, fits, widest, size = self.shorter, self.fits, self.widest, len(text)
        failed = bytearray(size // 8 + 1)
        token = shorter[token]
        while True:
            while token >= 0:
                end = at + length[token]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last < 0:
                        break
                    fit = checked(last << 32 | token)
                    if fits(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == size:
                    return tokens
                at, last = end, token
                token = next(matches(text[at : at + widest]))[1]  # each character is a match
            else:  # nothing goes on from here: a shorter piece must end before
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= length[token]
                token = shorter[token]
                last = tokens[-1] if tokens else -1

    def _part(self, text: str) -> list[int]:
        """The ids of a part, unknown characters as bytes or the unknown id (one a run)."""
        if self.known.issuperset(text):
            return self.encode_part(text)
        ids: list[int] = []
        for k, run in enumerate(self.unknown_run(text)):
            if k % 2 == 0:
                ids += self.encode_part(run) if run else ()
            elif self.byte:
                ids += map(self.byte.__getitem__, run.encode())
            else:
                ids.append(self.unknown)
        return ids

    def normalised(self, text: str) -> str:
        if not self.plain:
            return self.normalize(text)
        return SPACE * (self.leading and text != "") + text.replace(" ", SPACE)

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without those of its begin and end."""
        return [i for part in self.parts_of(self.normalised(text)) for i in self._part(part)]

    def decode(self, ids: list[int], begin: bool = True) -> str:
        """The text of ids: space marks become spaces but for leading ones that
        normalisation adds or drops (at a text's beginning), runs of bytes become
        characters, and each byte that belongs to none the replacement character."""
        out: list[str] = []
        if not begin and self.ordinary.issuperset(ids):
            return "".join([self.surface[i] for i in ids])
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_characters(run))
                run.clear()
                begin = False
            if self.control[i]:
                continue
            if i == self.unknown:
                out.append(self.unknown_text)
                begin = False
                continue
            text = self.piece[i]
            if begin and text.startswith(SPACE) and (self.leading or self.squeezed):
                text = text[1:]
                begin = self.squeezed and not text
            else:
                begin = False
            out.append(text.replace(SPACE, " "))
        return "".join([*out, _characters(run)])

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids as decimals joined by commas, decoded text). Parts
        end in front of a space mark, so their texts join up, but for the leading mark."""
        found, recent, earlier = [], self.recent, self.earlier
        parts = self.parts_of(self.normalised(text))
        for part in parts:
            known = recent.get(part)
            if known is None:
                known = earlier.get(part) or self._result(part)
                if len(part) <= 64:
                    if len(recent) >= PARTS:
                        self.earlier, self.recent = earlier, recent = recent, {}
                    recent[part] = known
            found.append(known)
        if not found:
            return 0, "", ""
        decoded = [x[2] for x in found]
        decoded[0] = self.decode(self._part(parts[0]))
        return sum([x[0] for x in found]), ",".join([x[1] for x in found]), "".join(decoded)

    def _result(self, part: str) -> tuple[int, str, str]:
        ids = self._part(part)
        return len(ids), ",".join([self.decimal[i] for i in ids]), self.decode(ids, begin=False)

def _characters(run: bytearray) -> str:
    """Bytes as text, each byte that begins no character replaced on its own."""
    out = []
    at = 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append(REPLACEMENT)
            at += 1
    return "".join(out)


@functools.cache
def model(path: str) -> Model:
    return Model(path)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, ids string, text string)``: the ids, joined by commas, and
    what they decode to."""
    path = path or default_path()

    def mapped(batches: Iterator[list]) -> Iterator[list]:
        m = model(path)
        for ids, texts in batches:
            for i, t in zip(ids, texts):
                yield [(i, *m.round_trip(t or "")[1:])]

    return map_rows(id_text(docs), mapped, "doc_id long, ids string, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the number of its ids and the digests of ids and decoded text."""
    path = path or default_path()

    def mapped(batches: Iterator[list]) -> Iterator[list]:
        m = model(path)
        for ids, texts in batches:
            rows = []
            for i, t in zip(ids, texts):
                n, numbers, decoded = m.round_trip(t or "")
                rows.append((i, n, _sha256(numbers), _sha256(decoded)))
            yield rows

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(id_text(docs), mapped, schema)
