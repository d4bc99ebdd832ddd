"""Byte-level BPE by tree reduction over encoded spans."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratewell.llm.common import in_blocks, worker_cache

#: Spans of up to so many bytes are merged directly; longer ones are halved.
LEAF = 16
#: Above every rank.
UNKNOWN = 1 << 30
#: Spans of a text that a worker remembers; the memory starts anew beyond that.
REMEMBERED = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a line per token, base64 and number."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Spans:
    """Encoded spans as a monoid: ``encode`` gives a span's element, ``join`` combines neighbours.

    Every token that merging yields is the encoding of its own bytes, and a sequence of such tokens
    is the encoding of its bytes if and only if each neighbouring pair is the encoding of the pair's
    bytes. So joining has to look at the seam only: it encodes a window around it anew and is done
    once the window's outer tokens agree with those just outside; all other pairs were right before.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        splits = [
            ((ranks[token[:i]] << 32) | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        keys, values = (np.array(column, np.int64) for column in zip(*sorted(splits) or [(-1, UNKNOWN)]))
        self.pair_keys, self.pair_values = keys, values
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.agreed: dict[tuple[int, int], bool] = {}

    def merged(self, span: bytes) -> list[int]:
        """Merge the lowest-ranked neighbours, the leftmost first, until none merge."""
        ranks = self.ranks
        parts = [span[i : i + 1] for i in range(len(span))]
        pairs = [ranks.get(a + b, UNKNOWN) for a, b in zip(parts, parts[1:])]
        while pairs and (low := min(pairs)) < UNKNOWN:
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], UNKNOWN)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], UNKNOWN)
        return [ranks[part] for part in parts]

    def leaves(self, spans: list[bytes]) -> list[list[int]]:
        """``merged`` of many spans of at most ``LEAF`` bytes at once, a row of a matrix per span."""
        import numpy as np

        order = sorted(range(len(spans)), key=lambda i: len(spans[i]))
        out: list = [None] * len(spans)
        for at in range(0, len(order), 4096):
            mine = np.array(order[at : at + 4096])
            width = max(len(spans[mine[-1]]), 2)
            raw = b"".join(spans[i].ljust(width, b"\0") for i in mine)
            sizes = np.array([len(spans[i]) for i in mine])
            steps = np.arange(width)
            tokens = self.byte_ids[np.frombuffer(raw, np.uint8)].reshape(-1, width)
            tokens[steps >= sizes[:, None]] = -1
            ranks = self.pair_ranks(tokens[:, :-1], tokens[:, 1:])
            while len(mine):
                rows, at_pair = np.arange(len(mine)), ranks.argmin(1)
                low = ranks[rows, at_pair]
                done = low == UNKNOWN
                if done.any():
                    for i, n, row in zip(mine[done].tolist(), sizes[done].tolist(), tokens[done].tolist()):
                        out[i] = row[:n]
                    mine, sizes, tokens, ranks, at_pair, low = (
                        x[~done] for x in (mine, sizes, tokens, ranks, at_pair, low)
                    )
                    rows = np.arange(len(mine))
                sizes -= 1
                width = max(int(sizes.max(initial=2)), 2)
                moved = steps[:width] + (steps[:width] > at_pair[:, None])
                tokens = np.column_stack([tokens, np.full(len(mine), -1, np.int32)])
                tokens[rows, at_pair] = low
                tokens = np.take_along_axis(tokens, moved, 1)
                ranks = np.column_stack([ranks, np.full((len(mine), 2), UNKNOWN, np.int32)])
                ranks = np.take_along_axis(ranks, moved[:, : width - 1], 1)
                for left in (at_pair - 1, at_pair):
                    some = (left >= 0) & (left < width - 1)
                    r, c = rows[some], left[some]
                    ranks[r, c] = self.pair_ranks(tokens[r, c], tokens[r, c + 1])
        return out

    def pair_ranks(self, left, right):
        """Rank of the token that each pair of tokens merges to, ``UNKNOWN`` for none or beyond the end."""
        import numpy as np

        keys = (left.astype(np.int64) << 32) | right
        found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[found] == keys) & (right >= 0), self.pair_values[found], UNKNOWN).astype(np.int32)

    def agree(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        key = (left, right)
        if key not in self.agreed:
            if len(self.agreed) > REMEMBERED:
                self.agreed.clear()
            self.agreed[key] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return self.agreed[key]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        if self.agree(left[-1], right[0]):
            return left + right
        width = 1
        while True:
            i, j = max(len(left) - width, 0), min(width, len(right))
            window = self.merged(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))
            if (not i or self.agree(left[i - 1], window[0])) and (j == len(right) or self.agree(window[-1], right[j])):
                return left[:i] + window + right[j:]
            width *= 2

    def encode_all(self, spans: list[bytes]) -> list[list[int]]:
        """Each span's leaves encoded, then neighbours joined level by level up its tree."""
        cuts = [range(0, len(span), LEAF) for span in spans]
        leaves = iter(self.leaves([span[i : i + LEAF] for span, cut in zip(spans, cuts) for i in cut]))
        out = []
        for cut in cuts:
            level = [next(leaves) for _ in cut]
            while len(level) > 1:
                pairs = [self.join(a, b) for a, b in zip(level[::2], level[1::2])]
                level = pairs + level[len(pairs) * 2 :]
            out.append(level[0] if level else [])
        return out


def text_encoder(path: str, pattern: str):
    """A function from texts to their ids, 32-bit integers in one bytes object per text, each match of
    ``pattern`` encoded on its own.

    A match never crosses from a visible character into a blank that a visible character follows,
    so texts are cut there first, and a worker remembers the ids of the pieces between.
    """
    import re
    from array import array

    import regex

    cache = worker_cache(path)
    if "spans" not in cache:
        cache["spans"], cache["known"], cache["matches"] = Spans(read_ranks(path)), {}, {}
    spans, known, matches = cache["spans"], cache["known"], cache["matches"]
    find = regex.compile(pattern).findall
    # A blank before white space or at the end; Python's class holds all that the pattern calls white space.
    unsafe = re.compile(" (?=\\s|$)").search
    cut = re.compile("(?= [^\\s]| [\x1c-\x1f])").split

    def learn(pieces: list[str]) -> list[bytes]:
        split = [find(piece) for piece in pieces]
        # A match that is itself a token is that token, whether or not merging would find it.
        new = {}
        for match in {match for found in split for match in found if match not in matches}:
            span = match.encode("utf-8", "replace")
            rank = spans.ranks.get(span)
            new[match] = [span] if rank is None else [rank]
        merge = [match for match, found in new.items() if type(found[0]) is bytes]
        for match, ids in zip(merge, spans.encode_all([new[match][0] for match in merge])):
            new[match] = ids
        out = []
        for found in split:
            ids = array("i")
            for match in found:
                ids.extend(new[match] if match in new else matches[match])
            out.append(ids.tobytes())
        matches.update((match, ids) for match, ids in new.items() if len(match) < 40)
        return out

    def encode(texts: list[str]) -> list[bytes]:
        if len(known) > REMEMBERED or len(matches) > REMEMBERED:
            known.clear()
            matches.clear()
        # Pieces of each text: those after a plain blank go by their word, others by their own text.
        whole = [list(filter(None, cut(text))) if unsafe(text) else None for text in texts]
        words = [None if parts else text.split(" ") for parts, text in zip(whole, texts)]
        fresh = {" " + word for row in words if row for word in row[1:] if word not in known}
        fresh.update(row[0] for row in words if row)
        fresh.update(piece for parts in whole if parts for piece in parts)
        fresh = list(fresh)
        ids = dict(zip(fresh, learn(fresh)))
        known.update((piece[1:], found) for piece, found in ids.items() if piece[:1] == " " and len(piece) < 40 and not unsafe(piece))
        out = []
        for parts, row in zip(whole, words):
            if parts:
                out.append(b"".join(map(ids.__getitem__, parts)))
            elif row:
                rest = [known[word] if word in known else ids[" " + word] for word in row[1:]]
                out.append(ids[row[0]] + b"".join(rest))
            else:
                out.append(b"")
        return out

    return encode


def decoder(ranks: dict[bytes, int]):
    """A function from ids to bytes: neighbours concatenated level by level."""
    tokens = {rank: token for token, rank in ranks.items()}

    def decode(ids: list[int]) -> bytes:
        # Concatenation is associative: sixteen leaves a step keep the tree shallow.
        level = [b"".join(map(tokens.__getitem__, ids[i : i + 4096])) for i in range(0, len(ids), 4096)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 16]) for i in range(0, len(level), 16)]
        return level[0] if level else b""

    return decode


def encode_rows(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` of each row's whole text. Null text counts as empty and has no ids; repeated
    rows are encoded alike; columns other than ``doc_id`` and ``text`` are ignored."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encode = text_encoder(path, pattern)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = [np.frombuffer(ids, np.int32) for ids in in_blocks(encode, texts)]
            columns = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode_rows(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, bytes)`` of each row's ids; null ids give null, none give no bytes."""

    def run(batches):
        import pyarrow as pa

        decode = decoder(read_ranks(path))
        for batch in batches:
            found = [None if ids.as_py() is None else decode(ids.as_py()) for ids in batch.column("ids")]
            columns = [batch.column("doc_id"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "bytes"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode each text where it lies and keep digests only:
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        ranks = read_ranks(path)
        encode, decode = text_encoder(path, pattern), decoder(ranks)
        names = {rank: str(rank) for rank in ranks.values()}
        for batch in batches:
            counts, digests, decoded = [], [], []
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for ids in in_blocks(encode, texts):
                ids = memoryview(ids).cast("i").tolist()
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode(ids)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
