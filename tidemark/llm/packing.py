"""Vector bin packing of tokenised examples into sequences.

A sequence has limits on tokens, on segments and on loss-bearing tokens at the same time. An example
that is longer than a sequence first fills whole sequences; the rest is placed by the dot-product
heuristic: among the waiting examples that fit, take the one whose demand, as a share of the limits,
has the largest dot product with what the open sequence has left. If none fits whole, one is cut to
fill it (where cutting is allowed).

Every Spark task packs its own documents in groups of ``GROUP`` examples, so nothing is shuffled and no
task holds more than a group. The examples left at the end of a task form sequences whose lengths are
powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import small_batches

TOKENS = 1024
SEGMENTS = 256
GROUP = 4096
CACHE_WORDS = 400_000
#: The pattern's white space (Unicode's), in runs that are encoded by themselves.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}")


class Packer:
    """Places (tokens, loss tokens) demands into sequences. ``out`` gets (example, start, length, sequence, offset)."""

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int | None = None, cut: bool = True):
        self.limits = np.array([tokens, segments, loss or tokens], np.float64)
        self.cut = cut
        self.next = 0

    @staticmethod
    def _most(free: np.ndarray, share: float) -> int:
        """Tokens of a piece that the free space allows, when ``share`` of them bear loss."""
        return int(min(free[0], free[2] // share if share else free[0]))

    @property
    def whole(self) -> int:
        """Tokens that one sequence takes of a long example whose tokens all bear loss."""
        return self._most(self.limits, 1.0)

    def pack(self, lengths: list[int], loss: list[int], tail: str = "pad") -> list[tuple[int, int, int, int, int]]:
        """Pieces of the examples, in sequences numbered on from earlier calls.

        ``loss`` counts each example's loss-bearing tokens; a piece bears its share of them, rounded up.
        ``tail`` says what becomes of a last sequence that is not full: "pad" leaves it, "binary" cuts it
        into sequences whose lengths are powers of two.
        """
        need = np.array([lengths, np.ones(len(lengths)), loss], np.float64).T.reshape(-1, 3)
        start = np.zeros(len(need), np.int64)
        share = need[:, 2] / np.maximum(need[:, 0], 1)
        out: list[tuple[int, int, int, int, int]] = []
        for k in range(len(need)):  # whole sequences of the long ones
            full = self._most(self.limits, share[k])
            while self.cut and need[k, 0] > full > 0:
                out.append((k, int(start[k]), full, self.next, 0))
                self.next += 1
                start[k] += full
                need[k, 0] -= full
                need[k, 2] = np.ceil(share[k] * need[k, 0])
        waiting = np.flatnonzero(need[:, 0] > 0)
        if not self.cut and ((need > self.limits).any()):
            raise ValueError("an example exceeds a limit by itself and cutting is off")
        while len(waiting):
            free, offset, pieces = self.limits.copy(), 0, []
            while len(waiting) and free[0] > 0 and free[1] >= 1 and free[2] >= 0:
                demand = need[waiting]
                fits = (demand <= free).all(axis=1)
                if fits.any():
                    value = np.where(fits, (demand / self.limits) @ (free / self.limits), -1.0)
                    best = int(value.argmax())
                    k = waiting[best]
                    pieces.append((int(k), int(start[k]), int(need[k, 0]), offset))
                    offset += int(need[k, 0])
                    free -= need[k]
                    waiting = np.delete(waiting, best)
                    continue
                if not self.cut:
                    break
                best = int((demand @ (1 / self.limits)).argmax())
                k = waiting[best]
                take = min(self._most(free, share[k]), int(need[k, 0]) - 1)
                if take < 1:
                    break
                pieces.append((int(k), int(start[k]), take, offset))
                offset += take
                free -= (take, 1, np.ceil(share[k] * take))
                start[k] += take
                need[k, 0] -= take
                need[k, 2] = np.ceil(share[k] * need[k, 0])
            if not pieces:  # no limit but the loss limit of a fresh sequence can stop here
                raise ValueError("an example fits into no sequence")
            last = not len(waiting) and offset < self.limits[0]
            if last and tail == "binary" and self.cut:
                self._binary(pieces, offset, out)
            else:
                out += [(k, s, n, self.next, o) for k, s, n, o in pieces]
                self.next += 1
        return out

    def _binary(self, pieces, total: int, out) -> None:
        sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        at, room = 0, sizes[0]
        for k, s, n, _ in pieces:
            while n:
                if not room:
                    at += 1
                    self.next += 1
                    room = sizes[at]
                take = min(n, room)
                out.append((k, s, take, self.next, sizes[at] - room))
                s, n, room = s + take, n - take, room - take
        self.next += 1


class Words(dict):
    """Token ids of the text between blanks (which includes the blank), made on first use."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if word[-1] in ".,;:!?|" and word[-2:-1].isalpha():  # letters and other marks are separate pieces
            ids = self[word[:-1]] + self.encode(word[-1])
        else:
            ids = self.encode(word if word[0] == "\n" else " " + word)
        if len(self) < CACHE_WORDS and len(word) < 64:
            self[word] = ids
        return ids


class Tokenizer:
    """Ids of the public byte-level BPE, as bytes of little-endian unsigned 32-bit numbers.

    ``ranks`` is the same vocabulary in the form of ranks, whose ids are equal (tests compare them with
    the ids of the tokenizers file). A blank or line end between two characters that are no white space
    always begins a new piece, so a text without other white space is cut there and each distinct word is
    encoded once; any other text is encoded in one go.
    """

    def __init__(self, ranks: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

        def plain(text: str) -> bytes:
            ids = array("I", own.encode_ordinary(text))
            if sys.byteorder == "big":
                ids.byteswap()
            return ids.tobytes()

        self.words = Words(plain)
        self._plain, blank = plain, tiktoken.Encoding("blank", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})

        def blanks(text: str) -> bytes:
            ids = array("I", blank.encode_ordinary(text))
            if sys.byteorder == "big":
                ids.byteswap()
            return ids.tobytes()

        self._blanks = blanks

    def plain(self, text: str) -> bytes:
        """Any text. The pattern takes a run of white space but for its last character as one piece (all of it at the
        end of the text), and needs stack for each character: long runs are cut out and encoded as that piece."""
        out, at = [], 0
        for run in LONG_BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += [self._plain(text[at:run.start()]), self._blanks(text[run.start():end])]
            at = end
        return self._plain(text) if not out else b"".join([*out, self._plain(text[at:])])

    def encode(self, text: str) -> bytes:
        flat = text.replace("\n", " ")
        if not flat.isprintable() or "  " in flat or not flat or flat[0] == " " or flat[-1] == " ":
            return self.plain(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.plain(first) + b"".join(map(self.words.__getitem__, rest))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokens: int = TOKENS,
                   segments: int = SEGMENTS, loss: int | None = None, ranks: str | None = None,
                   loss_tokens: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents.

    A document's ids are those of its text followed by id 0; null text has that id only. Each id lies in
    one piece. A sequence holds at most ``tokens`` ids, ``segments`` pieces and ``loss`` loss-bearing ids
    as the column ``loss_tokens`` counts them per document (instruction data: the answers), spread evenly over a
    document that is cut; null, and no such column, means that every id bears loss. Repeated rows and null keys are packed like other rows; very long texts are
    cut; an empty table gives no pieces; other columns are not read. Sequence ids join the number of the
    partition and a counter.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    bearing = F.lit(None).cast("long") if loss_tokens is None else F.col(loss_tokens).cast("long")
    taken = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), bearing.alias("b"))
    kind = taken.schema["k"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(batches):
        tokenizer, packer = Tokenizer(ranks), Packer(tokens, segments, loss)
        base = TaskContext.get().partitionId() << 36
        whole = packer.whole
        keys, rests, pieces = [], [], []

        def rows():
            return pa.RecordBatch.from_arrays([
                pa.array([p[0] for p in pieces], keys_type), *[pa.array([p[k] for p in pieces], pa.int64())
                                                               for k in range(1, 7)]], names)

        def settle(tail):
            loads = [len(r[1]) // 4 for r in rests]
            for k, s, n, sequence, offset in packer.pack(loads, [r[3] for r in rests], tail):
                start, ids, total, _ = rests[k]
                pieces.append((keys[k], start + s, n, zlib.crc32(ids[4 * s:4 * (s + n)]), total, base + sequence, offset))
            keys.clear()
            rests.clear()

        keys_type = None
        for batch in batches:
            keys_type = batch.column(0).type
            for doc, body, bears in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = tokenizer.encode(body or "") + b"\0\0\0\0"
                total, at = len(ids) // 4, 0
                while total - at > whole:
                    pieces.append((doc, at, whole, zlib.crc32(ids[4 * at:4 * (at + whole)]), total, base + packer.next, 0))
                    packer.next += 1
                    at += whole
                keys.append(doc)
                bears = total if bears is None else min(max(bears, 0), total)
                rests.append((at, ids[4 * at:], total, -(-bears * (total - at) // total)))
            if len(rests) >= GROUP:
                settle("binary")
            if pieces:
                yield rows()
                pieces.clear()
        if rests:
            settle("binary")
            yield rows()

    out = taken.mapInArrow(pack, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "sequence_id long, offset long")
    return out
