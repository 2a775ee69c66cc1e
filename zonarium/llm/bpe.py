"""Byte-level BPE: a priority queue of merge ranks over a doubly linked list.

A text is split at added tokens, then into words by the vocabulary's pattern.
Each different word is merged once per worker (a bounded table remembers it): its
symbols form a doubly linked list, all mergeable neighbours stand in a heap by
rank and place, and an entry whose symbols have changed since is skipped.
Decoding concatenates the vocabulary's strings and maps them back to bytes.

Defined results: a null text is empty and has no tokens; repeated rows are
encoded each; a null id stays null; columns other than the id and the text are
ignored; an empty table gives an empty result.  Texts are encoded whole.
"""

import hashlib
import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import functions as F

#: Words a Python worker remembers; beyond it the table starts anew.
MEMO_WORDS = 700_000
#: Fixed value: the pattern by which byte-level vocabularies split text.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols():
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(spare)
            spare += 1
    return symbols


class ByteBPE:
    """Encoder and decoder of one vocabulary, given as the file's JSON text."""

    def __init__(self, spec, memo_words=MEMO_WORDS):
        spec = json.loads(spec)
        model = spec["model"]
        vocab = model["vocab"]
        self.memo_words = memo_words
        self.memo = {}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        symbols = byte_symbols()
        values = {s: b for b, s in symbols.items()}
        # The bytes of every vocabulary string.
        self.bytes_of = {i: bytes([values[c] for c in s]) for s, i in (vocab | self.added).items()}
        self.first = [vocab[symbols[b]] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.words = regex.compile(WORDS).findall
        names = sorted(self.added, key=len, reverse=True)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def merge(self, word):
        """Token ids of one word."""
        ids = [self.first[b] for b in word.encode()]
        n = len(ids)
        if n == 1:
            return ids
        get, push, pop = self.merges.get, heapq.heappush, heapq.heappop
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            found = get((ids[i], ids[i + 1]))
            if found:
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = pop(heap)
            j = after[i]
            if ids[i] != left or j == n or ids[j] != right:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = get((new, ids[k]))
                if found:
                    push(heap, (found[0], i, new, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = get((ids[h], new))
                if found:
                    push(heap, (found[0], h, ids[h], new, found[1]))
        return [x for x in ids if x >= 0]

    def pieces(self, text):
        """Parts of a text: (is an added token, text)."""
        if not text:
            return []
        if self.splitter is None:
            return [(False, text)]
        return [(i % 2 == 1, part) for i, part in enumerate(self.splitter.split(text)) if part]

    def encode(self, text):
        ids = []
        for added, part in self.pieces(text):
            if added:
                ids.append(self.added[part])
            else:
                for word in self.words(part):
                    ids.extend(self.merge(word))
        return ids

    def decode_bytes(self, ids):
        """The bytes of the vocabulary's strings, one after the other."""
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids):
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def word(self, word):
        """(ids as text, bytes of the decoded ids) of a word, remembered."""
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= self.memo_words:
                self.memo.clear()
            ids = self.merge(word)
            found = self.memo[word] = (",".join(map(str, ids)), self.decode_bytes(ids))
        return found

    def digest(self, text):
        """(number of tokens, digest of the ids, digest of the decoded text)."""
        parts = []
        for added, part in self.pieces(text):
            if added:
                parts.append((str(self.added[part]), self.decode_bytes([self.added[part]])))
            else:
                parts.extend(map(self.word, self.words(part)))
        ids = ",".join([p[0] for p in parts])
        decoded = b"".join([p[1] for p in parts]).decode("utf-8", errors="replace")
        return (
            ids.count(",") + 1 if ids else 0,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def _rows(shared, make, schema):
    """Function for ``mapInArrow``; the encoder stays beside the broadcast text for a worker's next tasks."""
    names = pa.schema(schema)

    def run(batches):
        box = shared.value
        encoder = box.get("encoder")
        if encoder is None:
            encoder = box["encoder"] = ByteBPE(box["spec"])
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            columns = list(zip(*(make(encoder, t) for t in texts))) or [()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, f.type) for c, f in zip(columns, list(names)[1:]))], schema=names
            )

    return run


def encode_texts(documents, spec, doc_id="doc_id", text="text"):
    """Columns doc_id, ids (array of int), n_tokens.  ``spec``: the vocabulary file's text."""
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast({"spec": spec})  # one vocabulary file, of fixed size

    def make(encoder, value):
        ids = encoder.encode(value)
        return ids, len(ids)

    schema = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64())]
    return source.mapInArrow(_rows(shared, make, schema), "doc_id long, ids array<int>, n_tokens long")


def decode_ids(encoded, spec, doc_id="doc_id", ids="ids"):
    """Columns doc_id, text (null ids: empty)."""
    source = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    shared = encoded.sparkSession.sparkContext.broadcast({"spec": spec})
    schema = [("doc_id", pa.int64()), ("text", pa.string())]
    return source.mapInArrow(
        _rows(shared, lambda encoder, value: (encoder.decode(value or ()),), schema),
        "doc_id long, text string",
    )


def encoding_digests(documents, spec, doc_id="doc_id", text="text"):
    """Encode and decode every text; columns doc_id, n_tokens, ids_sha256, decoded_sha256."""
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast({"spec": spec})
    schema = [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
    return source.mapInArrow(
        _rows(shared, lambda encoder, value: encoder.digest(value), schema),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
