"""BPE encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Encoding a pretoken: bytes enter a buffer; a token is emitted once no byte still to come can change
it. Whether a merge (u, v) happens at a place is settled by the bytes up to its *reach*: the bytes
of u and v and the reach of every earlier merge that can take part of them away (``lookahead``).
The largest reach over the merge list is the sufficient lookahead: merging the buffer gives the
final tokens up to that many bytes before its end, and a token boundary, once final, separates the
text into parts that can be merged on their own. So memory stays at the lookahead plus one block,
however long the pretoken is; the end of a pretoken needs no lookahead. Pretokens of at most one
block are a single step and are kept in a bounded cache by the word they stand in.

Decoding feeds ids into a state machine that yields text as soon as it is complete: tokens joined
by a space where the file names no decoder (as the tokenizers library does), or bytes through an
incremental UTF-8 decoder where it names the byte-level one.

Null text is empty text: no tokens, an empty decoded text. The tokenizer file is read by the driver
(its size is fixed) and broadcast.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import current_scope
from .textcore import give_back

BLOCK = 1024          # bytes taken in before the buffer is merged again
CACHE_BYTES = 40 << 20  # of each of the two generations of the word cache, about
ENTRY_BYTES = 160     # of a cached word besides its letters and ids
DECODE_IDS = 1 << 16  # ids decoded at a time
_NO_RANK = 1 << 60
assert array("I").itemsize == 4 and sys.byteorder == "little"

# Lower-case forms that newer Unicode versions add to Python's (15.1).
NEW_CASES = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
# Code points that the installed regex module (Unicode 17) counts as letters or digits
# and the tokenizers library (Unicode 16) as symbols.
NOT_YET_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
]
_NOT_YET = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NOT_YET_LETTERS) + "]")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others take the characters from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, nxt = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in plain else chr(nxt))
        nxt += b not in plain
    return out


def lookahead(merges: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Bytes after which no merge decision can change any more.

    ``merges``: (left, right, result) ids in order of priority; ``length``: bytes of each token.
    A merge (u, v) depends on bytes up to: what makes u and v, the earlier merges that start with u
    (they would take u first), and those that start with v (they would take v away).
    """
    makes, starts, most = {}, {}, 1
    for u, v, new in merges:
        reach = max(makes.get(u, 0), starts.get(u, 0),
                    length[u] + max(length[v], makes.get(v, 0), starts.get(v, 0)))
        makes[new] = max(makes.get(new, 0), reach)
        starts[u] = max(starts.get(u, 0), reach)
        most = max(most, reach)
    return most


def load_tables(path: str) -> dict:
    """The tables that encoding and decoding need, from a tokenizer file of the tokenizers
    library (BPE, byte-level pretokens, optional end-of-word suffix)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    alphabet = byte_alphabet()
    merges, ranks = [], {}
    for rank, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        ids = vocab[a], vocab[b], vocab[a + b]
        merges.append(ids)
        ranks.setdefault(ids[0] << 32 | ids[1], rank << 32 | ids[2])
    length = {i: len(t.removesuffix(suffix) if suffix else t) or 1 for t, i in vocab.items()}
    tokens = {i: t for t, i in vocab.items()}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens.update({i: t for t, i in added.items()})
    pattern, lower, form, spaces = None, False, None, False
    normal = spec.get("normalizer") or {}
    for step in normal.get("normalizers", [normal] if normal else []):
        if step["type"] == "Lowercase":
            lower = True
        elif step["type"] in ("NFC", "NFD", "NFKC", "NFKD"):
            form = step["type"]
        elif step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " ":
            spaces = True
        else:
            raise ValueError(f"normalizer not supported: {step}")
    pre = spec["pre_tokenizer"]
    for step in pre.get("pretokenizers", [pre]):
        if step["type"] == "Split" and step["invert"] and step["behavior"] == "Removed":
            pattern = step["pattern"]["Regex"]
        elif step["type"] != "ByteLevel" or step["use_regex"] or step["add_prefix_space"]:
            raise ValueError(f"pretokenizer not supported: {step}")
    if pattern is None or not spaces:
        raise ValueError("only files whose pretokens never hold white space are supported")
    return {
        "ranks": ranks, "lookahead": lookahead(merges, length), "pattern": pattern, "lower": lower, "form": form,
        "first": [vocab[c] for c in alphabet],
        "last": [vocab[c + suffix] for c in alphabet],
        "tokens": [tokens.get(i, "") for i in range(max(tokens) + 1)],
        "added": added,
        "decoder": (spec.get("decoder") or {}).get("type"),
    }


def merge_all(ids: list[int], ranks: dict) -> list[int]:
    """BPE of a list of ids: the pair of lowest rank first, the leftmost of equals."""
    pairs = [ranks.get(a << 32 | b, _NO_RANK) for a, b in zip(ids, ids[1:])]
    while pairs:
        best = min(pairs)
        if best == _NO_RANK:
            break
        i = pairs.index(best)
        ids[i:i + 2] = [best & 0xFFFFFFFF]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(ids[i] << 32 | ids[i + 1], _NO_RANK)
        if i:
            pairs[i - 1] = ranks.get(ids[i - 1] << 32 | ids[i], _NO_RANK)
    return ids


class Transducer:
    """Encodes one pretoken given in pieces; ``push`` and ``close`` return the tokens now final."""

    def __init__(self, tables: dict, block: int = BLOCK):
        self.t, self.block, self.buffer = tables, block, bytearray()
        self.most = 0  # largest buffer seen

    def push(self, data: bytes) -> list[int]:
        out, t = [], self.t
        for a in range(0, len(data), self.block):
            self.buffer += data[a:a + self.block]
            self.most = max(self.most, len(self.buffer))
            # The byte at the end may be the pretoken's last, which has a symbol of its own.
            limit = len(self.buffer) - 1 - t["lookahead"]
            if limit < self.block:
                continue
            first, lengths = t["first"], t["lengths"]
            at = 0
            for i in merge_all([first[b] for b in self.buffer], t["ranks"]):
                if at + lengths[i] > limit:
                    break
                at += lengths[i]
                out.append(i)
            del self.buffer[:at]
        return out

    def close(self) -> list[int]:
        if not self.buffer:
            return []
        t = self.t
        ids = [t["first"][b] for b in self.buffer]
        ids[-1] = t["last"][self.buffer[-1]]
        self.buffer = bytearray()
        return merge_all(ids, t["ranks"])


class Encoder:
    """Text to ids. Whatever is kept between texts is bounded by the cache's size."""

    def __init__(self, tables: dict):
        self.t = t = dict(tables)
        # Bytes of each symbol before the end of a pretoken (the end-of-word forms only close one).
        alphabet = set(byte_alphabet())
        t["lengths"] = [sum(c in alphabet for c in x) for x in t["tokens"]]
        self.pieces = regex.compile(t["pattern"])
        self.added = regex.compile("(" + "|".join(map(regex.escape, sorted(t["added"], key=len, reverse=True))) + ")") if t["added"] else None
        self.not_yet, self.cases = _NOT_YET, NEW_CASES
        self.rare = regex.compile("[\x1c-\x1f]")  # white space to Python's split, not to the tokenizer
        self.young, self.old, self.held = {}, {}, 0

    def pretoken(self, data: bytes) -> list[int]:
        t = self.t
        if len(data) <= BLOCK:  # ends within the first block: one step
            first = t["first"]
            ids = [first[b] for b in data]
            ids[-1] = t["last"][data[-1]]
            return merge_all(ids, t["ranks"])
        step = Transducer(t)
        return step.push(data) + step.close()

    def word(self, word: str) -> bytes:
        """Ids of a stretch of text without white space at which it could be cut, as uint32 bytes."""
        t = self.t
        text = word
        if text.isascii():
            if t["lower"]:
                text = text.lower()
            pieces = self.pieces.findall(text)
        else:
            if t["form"]:
                text = unicodedata.normalize(t["form"], text)
            if t["lower"]:
                # Lower-casing looks at one character at a time.
                text = text.replace("Σ", "σ").translate(self.cases).lower()
            shape = self.not_yet.sub("\ue000", text)
            pieces = [text[m.start():m.end()] for m in self.pieces.finditer(shape)]
        if len(pieces) == 1 and pieces[0] == word:
            return array("I", self.pretoken(word.encode())).tobytes()
        # A pretoken that stands alone as a word has the same ids, so both share the cache.
        return b"".join([self._kept(x) for x in pieces])

    def _kept(self, word: str) -> bytes:
        got = self.young.get(word)
        if got is None:
            got = self.old.get(word)
            if got is None:
                got = self.word(word)
            if len(word) <= 64:
                if self.held >= CACHE_BYTES:
                    self.young, self.old, self.held = {}, self.young, 0
                self.young[word] = got
                self.held += ENTRY_BYTES + len(word) + len(got)
        return got

    def plain(self, text: str):
        """The ids of text without added tokens, in parts."""
        if self.rare.search(text):
            for part in regex.split("[ \\t\\n\\r\\f\\v]+", text):
                yield self.word(part)
        else:
            young, kept = self.young, self._kept
            for w in text.split():
                yield young.get(w) or kept(w)
                young = self.young

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        parts = self.added.split(text) if self.added and any(a in text for a in self.t["added"]) else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([self.t["added"][part]], "<u4").tobytes())
            else:
                out.extend(self.plain(part))
        return np.frombuffer(b"".join(out), "<u4")


class Decoder:
    """Ids to text, in pieces: what ``feed`` and ``close`` return, joined, is the decoded text."""

    def __init__(self, tables: dict):
        self.tokens, self.started = tables["tokens"], False
        self.bytes = None
        if tables["decoder"] == "ByteLevel":
            back = {c: b for b, c in enumerate(byte_alphabet())}
            self.bytes = [bytes(back[c] for c in x) if all(c in back for c in x) else x.encode() for x in self.tokens]
            self.state = codecs.getincrementaldecoder("utf-8")("replace")
        elif tables["decoder"] is not None:
            raise ValueError(f"decoder not supported: {tables['decoder']}")

    def feed(self, ids) -> str:
        if self.bytes is not None:
            return self.state.decode(b"".join([self.bytes[i] for i in ids]))
        if not len(ids):
            return ""
        text = " ".join([self.tokens[i] for i in ids])
        text, self.started = (" " + text if self.started else text), True
        return text

    def close(self) -> str:
        return self.state.decode(b"", True) if self.bytes is not None else ""


def decode(tables: dict, ids) -> str:
    step = Decoder(tables)
    parts = [step.feed(ids[a:a + DECODE_IDS].tolist()) for a in range(0, len(ids), DECODE_IDS)]
    return "".join([*parts, step.close()])


def encode_documents(docs: DataFrame, text: str = "text", tokenizer: str | None = None,
                     keep: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """The kept columns and ``n_tokens``, ``ids`` (array<int>, if asked for), ``ids_sha256`` (of
    the ids as little-endian unsigned 32-bit numbers) and ``decoded_sha256`` (of the decoded text
    in UTF-8). Input columns of those names are replaced, other columns are kept as they are, whatever
    their names. An empty table gives no rows. A very long text is held whole with its ids, its words are
    encoded one by one. One pass, no shuffle."""
    new = [T.StructField("n_tokens", T.LongType())]
    if with_ids:
        new.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))
    new += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    names = [f.name for f in new]
    carried = [c for c in (docs.columns if keep is None else keep) if c not in names]
    kept = docs.select(*[f"`{c}`" for c in carried])
    shared = docs.sparkSession.sparkContext.broadcast(load_tables(tokenizer or default_tokenizer()))
    current_scope().broadcasts.append(shared)

    def run(batches):
        give_back()
        tables = shared.value
        encoder = tables.get("encoder")  # kept with the broadcast, for the worker's later tasks
        if encoder is None:
            encoder = tables["encoder"] = Encoder(tables)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a in range(0, len(column), 256):
                counts, lists, sums, texts = [], [], [], []
                for value in column.slice(a, 256):
                    ids = encoder.encode(value.as_py())
                    counts.append(len(ids))
                    sums.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    digest, step = hashlib.sha256(), Decoder(tables)
                    for b in range(0, len(ids), DECODE_IDS):
                        digest.update(step.feed(ids[b:b + DECODE_IDS].tolist()).encode())
                    digest.update(step.close().encode())
                    texts.append(digest.hexdigest())
                    if with_ids:
                        lists.append(ids)
                arrays = [batch.column(i).slice(a, 256) for i in range(batch.num_columns - 1)]
                arrays.append(pa.array(counts, pa.int64()))
                if with_ids:
                    bounds = np.zeros(len(counts) + 1, np.int32)
                    np.cumsum(counts, out=bounds[1:])
                    flat = np.concatenate(lists).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(sums), pa.array(texts)], names=[*carried, *names])

    source = docs.select(*[f"`{c}`" for c in carried], docs[text].alias("_text"))
    return source.mapInArrow(run, T.StructType([*kept.schema.fields, *new]))
