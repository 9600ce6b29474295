"""Fast exact encoding with a public byte-level BPE tokenizer.

Its pieces never reach across the start of a run of white space that follows another
character, nor from an ASCII letter or digit into an ASCII sign, so a text is the
concatenation of independent units that begin there. Units are found and hashed on the
buffer, and the tokenizer encodes each different unit once; a worker process keeps a
bounded table of the units it has seen. Texts with white space beyond ASCII or with the
content of an added token (``<|endoftext|>``) are encoded as they are.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa

from assay.llm.common import Slots, chunks, ranges, span_hash

#: Units that a worker process keeps; beyond it the table starts anew.
TABLE_UNITS = 1_000_000
#: Bytes of whole documents that are encoded at once: numbers of a few dozen bytes for each of them are held.
ENCODE_BYTES = 1 << 18
MODEL = "byte_bpe_50k.json"

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: 1 white space, 2 ASCII letters and digits, 3 other ASCII characters, 0 the rest.
KIND = np.array([1 if SPACE[b] else 0 if b >= 0x80 or b < 0x20 else 2 if chr(b).isalnum() else 3 for b in range(256)], np.uint8)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def different(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes, where each comes first, and the number of each entry among them."""
    coded = pa.array(h.view(np.int64)).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    first = np.zeros(len(coded.dictionary), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return coded.dictionary.to_numpy(), first, code


class Encoder:
    """Token ids of documents in a buffer; one for each worker process and model.

    With ``added``, the content of an added token in a text becomes that token, as the tokenizer
    does when it is loaded; without, special ones are encoded like any other text.
    """

    def __init__(self, model: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model)
        self.tokenizer.encode_special_tokens = not added
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [np.frombuffer(x.content.encode(), np.uint8) for x in tokens if x.content and (added or not x.special)]
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.clear()

    @classmethod
    def get(cls, model: str):
        table = sys.modules.setdefault("_assay_encoders", {})  # outlives a task, as worker processes do
        if model not in table:
            table[model] = cls(model, added=True)
        return table[model]

    def clear(self):
        self.index = Slots()
        self.store = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(1 << 18, np.int64)
        self.size = np.zeros(1 << 18, np.int64)
        self.used = 0

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        n, at = len(hashes), len(self.index)
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate((self.store, np.zeros_like(self.store)))
        while at + n > len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        self.store[self.used : self.used + len(ids)] = ids
        self.begin[at : at + n] = self.used + np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.size[at : at + n] = sizes
        self.index.add(hashes)
        self.used += len(ids)

    def _learn(self, raw: np.ndarray, hashes: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Encode units that are not in the table."""
        data = raw.tobytes()
        texts = [data[s:e].decode() for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        # a line feed before a unit of a blank and other characters is a piece of its own, and so
        # separates units that are encoded side by side
        chain = (raw[start] == 0x20) & (end - start > 1) & ~SPACE[raw[np.minimum(start + 1, len(raw) - 1)]]
        alone = np.flatnonzero(~chain)
        if len(alone):
            found = self.tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
            ids = [np.array(x.ids, np.uint32) for x in found]
            self._keep(hashes[alone], np.concatenate(ids), np.array([len(x) for x in ids]))
        linked = np.flatnonzero(chain)
        for a in range(0, len(linked), 2000):
            part = linked[a : a + 2000]
            line = "\n".join([texts[i] for i in part])
            ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.flatnonzero(ids == self.line_feed)
            sizes = np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1
            self._keep(hashes[part], ids[ids != self.line_feed], sizes)

    def encode(self, buf: np.ndarray, offs: np.ndarray):
        """Yields (first row, end row, ids, ends of rows in ids) for ranges of documents."""
        for a, b in chunks(offs, ENCODE_BYTES):
            yield a, b, *self._range(buf, offs[a : b + 1])

    def _range(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo = int(offs[0])
        raw, offs = buf[lo : int(offs[-1])], offs - lo
        n = len(offs) - 1
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        kind = KIND[raw]
        new = np.zeros(len(raw), bool)
        new[1:] = ((kind[1:] == 1) & (kind[:-1] != 1)) | ((kind[1:] == 3) & (kind[:-1] == 2))
        heads = offs[:-1][np.diff(offs) > 0]
        new[heads] = True
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(raw)))
        h, pick, code = different(span_hash(raw, start, length))
        if len(self.index) > TABLE_UNITS:
            self.clear()
        slot = self.index.find(h)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            pick = pick[missing]
            self._learn(raw, h[missing], start[pick], start[pick] + length[pick])
            slot = self.index.find(h)
        slot = slot[code]
        sizes = self.size[slot]
        ids = self.store[ranges(self.begin[slot], sizes)]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ends = total[np.searchsorted(start, offs[1:])]
        odd = np.concatenate((self._wide_space(raw), self._added_tokens(raw)))
        if len(odd):
            ids, ends = self._replace(raw, offs, ids, ends, np.unique(np.searchsorted(offs, odd, side="right") - 1))
        return ids, ends

    def _wide_space(self, raw: np.ndarray) -> np.ndarray:
        """Positions of white space characters beyond ASCII."""
        lead = np.flatnonzero((raw == 0xC2) | (raw == 0xE1) | (raw == 0xE2) | (raw == 0xE3))
        if not len(lead):
            return lead
        one = raw[np.minimum(lead + 1, len(raw) - 1)]
        two = raw[np.minimum(lead + 2, len(raw) - 1)]
        head = raw[lead]
        wide = (head == 0xC2) & ((one == 0x85) | (one == 0xA0))
        wide |= (head == 0xE1) & (one == 0x9A) & (two == 0x80)
        wide |= (head == 0xE2) & (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))
        wide |= (head == 0xE2) & (one == 0x81) & (two == 0x9F)
        wide |= (head == 0xE3) & (one == 0x80) & (two == 0x80)
        return lead[wide]

    def _added_tokens(self, raw: np.ndarray) -> np.ndarray:
        """Positions of the contents of added tokens (also across the ends of documents, which does no harm)."""
        found = [np.zeros(0, np.int64)]
        for content in self.added:
            at = np.flatnonzero(raw[: max(len(raw) - len(content) + 1, 0)] == content[0])
            for i, byte in enumerate(content[1:].tolist(), 1):
                at = at[raw[at + i] == byte]
            found.append(at)
        return np.concatenate(found)

    def _replace(self, raw, offs, ids, ends, rows):
        """Encode whole texts for the given rows."""
        begin = np.concatenate(([0], ends[:-1]))
        parts = [ids[x:y] for x, y in zip(begin.tolist(), ends.tolist(), strict=True)]
        for r in rows.tolist():
            text = raw[offs[r] : offs[r + 1]].tobytes().decode()
            parts[r] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])
