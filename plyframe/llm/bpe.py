"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word one token is stored: the last token of that prefix's encoding.  An
automaton over the vocabulary names, at each position, all tokens that end there, longest first.
The one that belongs is the one that is compatible with the last token of the prefix before it:
the pair, encoded as one string, must come out as that pair.  Merging is deterministic, so exactly
one token fits, and following the stored tokens back from the end gives the exact ids.

Vocabularies are ``tokenizers`` files of the form: NFC, white space, lower case; words cut by a
pattern; bytes as printable characters; merges with an end-of-word mark; special tokens first.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare

#: The file's white space is Unicode's; Python's split() has four separators more.
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")
HELD_WORDS = 300_000
HELD_PAIRS = 500_000


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it has one, else the next free from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class Tokenizer:
    """Encoder and decoder of one vocabulary file, given as its bytes."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in self.vocab.items()}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token |= {i: t for t, i in special.items()}
        self.special = special
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        cut = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(cut.replace(r"\s", r"\p{White_Space}"), regex.V0)
        self.byte = byte_characters()
        self._learn(model["merges"])
        self.held: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def _learn(self, merges: list) -> None:
        """Ranks and halves of all tokens, then the automaton of those that can occur."""
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for n, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.merge.setdefault((a, b), n)
            if whole not in self.rank:
                self.rank[whole], self.halves[whole] = n, (a, b)
        # Tokens as symbols: characters, the last one with the end mark where the token has it.
        self.next: list[dict[str, int]] = [{}]
        ends: list[int | None] = [None]
        reach: dict[int, bool] = {}
        for text, token in self.vocab.items():
            if token in self.halves:
                a, b = self.halves[token]
                ok = reach.get(a, True) and reach.get(b, True) and self._uncrossed(a, b)
                reach[token] = ok
                if not ok:
                    continue
            node = 0
            for s in self.symbols(text.removesuffix(self.end), text.endswith(self.end) and bool(self.end)) if text != self.end else [text]:
                if s not in self.next[node]:
                    self.next[node][s] = len(self.next)
                    self.next.append({})
                    ends.append(None)
                node = self.next[node][s]
            ends[node] = token
        self.length = {}
        self.fall = [0] * len(self.next)
        self.out: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        queue = [(node, 0, 1, s) for s, node in self.next[0].items()]
        for node, parent, depth, s in queue:  # breadth first: the fallen state is ready before it is asked
            if parent or depth > 1:
                at = self.fall[parent]
                while at and s not in self.next[at]:
                    at = self.fall[at]
                self.fall[node] = self.next[at].get(s, 0)
            own = ((ends[node], depth),) if ends[node] is not None else ()
            self.out[node] = own + self.out[self.fall[node]]
            queue.extend((child, node, depth + 1, x) for x, child in self.next[node].items())

    def symbols(self, text: str, ended: bool) -> list[str]:
        found = list(text)
        if ended and found:
            found[-1] += self.end
        return found

    def _uncrossed(self, a: int, b: int) -> bool:
        """Do ``a`` and ``b`` both come about side by side, with no merge across their border before?

        Undoes the later of the two tokens' last merges again and again; equal ranks apply from the
        left, so the right one is the later.  A merge across the border that would have come
        earlier than the one undone contradicts the pair.
        """
        rank = self.rank
        while True:
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if rb >= ra:
                b = self.halves[b][0]
                if self.merge.get((a, b), rb + 1) <= rb:
                    return False
            else:
                a = self.halves[a][1]
                if self.merge.get((a, b), ra) < ra:
                    return False

    def compatible(self, a: int, b: int) -> bool:
        """Does the text of tokens ``a`` and ``b`` together encode as just these two?"""
        return (a, b) not in self.merge and self._uncrossed(a, b)

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word of the cut text."""
        mapped = word if word.isascii() and word.isalnum() else "".join([self.byte[b] for b in word.encode()])
        follow, fall, out, pairs = self.next, self.fall, self.out, self.pairs
        state, last, steps = 0, [], []
        for i, s in enumerate(self.symbols(mapped, bool(self.end))):
            while (to := follow[state].get(s)) is None and state:
                state = fall[state]
            state = to or 0
            for token, length in out[state]:
                if length > i:
                    break
                pair = last[i - length] << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= HELD_PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self.compatible(last[i - length], token)
                if fits:
                    break
            else:
                raise ValueError(f"no token ends at {i} in {word!r}")
            last.append(token)
            steps.append(length)
        ids, at = [], len(last) - 1
        while at >= 0:
            ids.append(last[at])
            at -= steps[at]
        return tuple(reversed(ids))

    def normal(self, text: str) -> str:
        """NFC and lower case, each character by itself (no final sigma)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.  No word holds white space, so stretches between it are looked up first."""
        ids: list[int] = []
        held = self.held
        for part, token in self._parts(text):
            normal = self.normal(part)
            for stretch in normal.split() if not SEPARATORS.search(normal) else SPACE.split(normal):
                found = held.get(stretch)
                if found is None:
                    if stretch.isalpha():
                        found = self.encode_word(stretch)
                    else:
                        several: list[int] = []
                        for word in self.words.findall(stretch):
                            several += held.get(word) or self._hold(word, self.encode_word(word))
                        found = tuple(several)
                    self._hold(stretch, found)
                ids += found
            if token is not None:
                ids.append(token)
        return ids

    def _hold(self, text: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(text) <= 40:
            if len(self.held) >= HELD_WORDS:
                self.held.clear()
            self.held[text] = ids
        return ids

    def _parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of ordinary text, each with the special token that ends it."""
        start = 0
        for m in self.special_pattern.finditer(text) if self.special_pattern and any(x in text for x in self.special) else ():
            yield text[start : m.start()], self.special[m.group()]
            start = m.end()
        yield text[start:], None

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, special ones too: the file names no decoder.  Unknown ids are skipped."""
        token = self.token
        return " ".join([token[i] for i in ids if i in token])


_tokenizers: dict[bytes, Tokenizer] = {}


def tokenizer(content: bytes) -> Tokenizer:
    """One per worker process and file."""
    if content not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[content] = Tokenizer(content)
    return _tokenizers[content]


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` plus ids (array of int) and decoded (text); columns of those names are replaced.

    ``vocabulary`` is the path of the file on the driver; its content is broadcast (a few MB).
    Defined cases: null text counts as empty and gives no ids and an empty text; texts are encoded
    whole; repeated rows are encoded alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession, 128)
    shared = docs.sparkSession.sparkContext.broadcast(read_file(vocabulary))
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(shared.value)
        for batch in batches:
            ids, texts = [], []
            for text in batch.column("text").to_pylist():
                found = t.encode(text or "")
                ids.append(pa.array(found, pa.int32()))
                texts.append(t.decode(found))
            ends = pa.array([0, *map(len, ids)], pa.int32()).to_numpy().cumsum(dtype="int32")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(ids) if ids else pa.array([], pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists, pa.array(texts, pa.string())], names=[*kept, "ids", "decoded"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept).mapInArrow(run, f"{types}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded documents."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
