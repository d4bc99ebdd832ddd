"""Best-two-fit packing of tokenised documents into sequences of one length."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import saved, text_blocks, worker_cache

SEQUENCE = 2048
#: Id after the last token of each document.
END_ID = 0
#: Fixed value: the pattern of the vocabulary file whose words can be encoded by their units.
UNITS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: Bytes of text that are encoded at a time.
BLOCK_BYTES = 1 << 20
#: Words, and units of words, whose ids a worker remembers; the memory starts anew beyond that.
REMEMBERED = 400_000
#: Ranks within a length are counted in so many parts at least, each of so many pieces at most on average.
PARTS, PART_ROWS = 64, 50_000


def word_ids(path: str):
    """A function from an Arrow array of texts to their ids: ``(ids, ends)``, all ids in one array and where
    each text's end.

    The tokenizer drops white space and never joins across it, so each distinct run of other
    characters is encoded once per worker. Texts are cut at ASCII white space and a block's words
    numbered by their first occurrence in Arrow; only distinct words of a block are looked at one by
    one, and ids are gathered by number. A text that holds one of the few control characters that
    Arrow might take for white space and the tokenizer doesn't, or a token that the tokenizer finds
    in raw text, goes to the tokenizer whole.

    A word is encoded by the units that the tokenizer's own pattern cuts it into, and each distinct
    unit once. That needs words whose normal form and lower case are plain: visible ASCII and the
    letters of Latin-1, where every character stands for itself, and a file with the pattern that is
    stated below. Other words, and all words of other files, go to the tokenizer. Units are in normal form
    and lower case already, so they are only written in the tokenizer's letters for bytes and merged.
    """
    import json
    import re
    from array import array
    from itertools import chain, filterfalse

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

    cache = worker_cache(path)
    if "tokenizer" not in cache:
        tokenizer = Tokenizer.from_file(path)
        cache["tokenizer"], cache["words"], cache["units"] = tokenizer, {}, {}
        vocabulary = tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[rank for token, rank in vocabulary.items() if token.endswith("</w>")]] = True
        cache["ends"] = ends
        found = json.dumps(json.loads(tokenizer.to_str())["pre_tokenizer"])
        cache["by_units"] = json.dumps(UNITS)[1:-1] in found
        cache["as_read"] = tokenizer.normalizer, tokenizer.pre_tokenizer
        letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        signs = [*map(chr, range(33, 127)), *map(chr, range(192, 256))]
        cache["letters"] = {ord(sign): letters(sign)[0][0] for sign in signs}
        cache["raw"] = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    tokenizer, known, unit_ids, ends = (cache[name] for name in ("tokenizer", "words", "units", "ends"))
    plain = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch if cache["by_units"] else lambda word: None
    # The units of lower-case words of the characters above by the pattern in ``UNITS``.
    units_of = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall

    def whole(texts):
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", encoding.ids).tobytes() for encoding in found]

    def learn_units(units):
        """Many units share a call and are told apart by the tokens that end a unit."""
        try:
            tokenizer.normalizer, tokenizer.pre_tokenizer = None, WhitespaceSplit()
            text = " ".join(units).translate(cache["letters"])
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        finally:
            tokenizer.normalizer, tokenizer.pre_tokenizer = cache["as_read"]
        cuts = (np.flatnonzero(ends[ids]) + 1).tolist() if len(ids) else []
        if len(cuts) != len(units):
            raise ValueError("each unit must end in one token that ends a word")
        raw, at = ids.tobytes(), 0
        for unit, cut in zip(units, cuts):
            unit_ids[unit] = raw[at : 4 * cut]
            at = 4 * cut

    def learn(words):
        easy = list(filter(plain, words))
        cut = [units_of(word) for word in map(str.lower, easy)]
        if new := set(chain.from_iterable(cut)).difference(unit_ids):
            learn_units(list(new))
        for word, units in zip(easy, cut):
            known[word] = unit_ids[units[0]] if len(units) == 1 else b"".join([unit_ids[unit] for unit in units])
        if len(easy) < len(words):
            rest = list(filterfalse(known.__contains__, words))
            known.update(zip(rest, whole(rest)))

    def encode(texts):
        if len(known) > REMEMBERED:
            known.clear()
        if len(unit_ids) > REMEMBERED:
            unit_ids.clear()
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]")
        for content in cache["raw"]:
            odd = pc.or_(odd, pc.match_substring(texts, content, ignore_case=True))
        split = pc.ascii_split_whitespace(pc.if_else(odd, "", texts))
        numbered = split.flatten().dictionary_encode()
        words = numbered.dictionary.to_pylist()
        learn(list(filterfalse(known.__contains__, words)))
        raw = list(map(known.__getitem__, words))
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        start = np.cumsum(size) - size
        table = np.frombuffer(b"".join(raw), np.uint32)
        word = numbered.indices.to_numpy(zero_copy_only=False)
        sizes = size[word]
        upto = np.append(0, np.cumsum(sizes))
        place = np.arange(upto[-1]) + np.repeat(start[word] - upto[:-1], sizes)
        ids, stops = table[place], upto[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]
        if not pc.any(odd, min_count=0).as_py():
            return ids, stops
        parts = np.split(ids, stops[:-1])
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            parts[i] = np.frombuffer(whole([texts[int(i)].as_py()])[0], np.uint32)
        return np.concatenate(parts), np.cumsum([len(part) for part in parts])

    return encode


def tokenize(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: a document's ids and the end id, cut only if longer than
    a sequence. ``ids`` are little-endian 32-bit integers. Null text counts as empty: its one piece is
    the end id. Every row gives its own pieces; columns other than ``doc_id`` and ``text`` are ignored.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        encode = word_ids(tokenizer)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, texts in text_blocks(pc.fill_null(batch.column("text"), ""), BLOCK_BYTES):
                ids, stops = encode(texts)
                ids = np.insert(ids, stops, END_ID).astype("<u4")
                stops = stops + np.arange(1, len(texts) + 1)
                lengths = np.diff(stops, prepend=0)
                pieces = -(-lengths // sequence)
                doc = np.repeat(np.arange(len(texts)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * sequence
                length = np.minimum(lengths[doc] - start, sequence)
                upto = np.append(0, np.cumsum(4 * length)).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(upto), pa.py_buffer(ids)])
                columns = [
                    doc_ids.take(pa.array(first + doc)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int32)),
                    raw,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length int, ids binary")


def best_two_fit(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences as ``(how many, [(length, times), ...])`` that together hold exactly ``counts``.

    A sequence is filled greedily, the longest piece that fits first. Then, as long as that closes
    the gap further, its shortest piece gives way to the two unpacked pieces that fit the widened gap
    most tightly. Equal pieces are interchangeable, so a filling is used for as many sequences as
    the counts allow: the work depends on the number of distinct lengths, not of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    order = sorted(left)
    made = []

    def longest(limit, used):
        """Longest length up to ``limit`` of which more pieces are left than ``used`` holds."""
        for i in range(bisect_right(order, limit) - 1, -1, -1):
            if left[order[i]] > used.get(order[i], 0):
                return order[i]
        return 0

    while order:
        used, room = {}, sequence
        while length := longest(room, used):
            times = min(room // length, left[length] - used.get(length, 0))
            used[length] = used.get(length, 0) + times
            room -= times * length
        while room:
            shortest = min(used)
            gap, best = room + shortest, (shortest, 0, 0)
            spare = used | {shortest: used[shortest] - 1}
            for first in reversed(order[: bisect_left(order, gap)]):
                if 2 * first <= best[0]:
                    break
                if left[first] <= spare.get(first, 0):
                    continue
                second = longest(min(gap - first, first), spare | {first: spare.get(first, 0) + 1})
                if second and first + second > best[0]:
                    best = (first + second, first, second)
                    if best[0] == gap:
                        break
            if not best[1]:
                break
            used = {k: n for k, n in spare.items() if n}
            for length in best[1:]:
                used[length] = used.get(length, 0) + 1
            room = gap - best[0]
        times = min(left[length] // n for length, n in used.items())
        made.append((times, sorted(used.items(), reverse=True)))
        for length, n in used.items():
            left[length] -= n * times
        order = [length for length in order if left[length]]
    return made


def slots(made: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, list[tuple]]:
    """Per length the runs ``(first rank, per sequence, first sequence, offset)``, ranks ascending."""
    runs, taken, sequence = {}, {}, 0
    for times, filling in made:
        offset = 0
        for length, n in filling:
            first = taken.get(length, 0)
            runs.setdefault(length, []).append((first, n, sequence, offset))
            taken[length] = first + n * times
            offset += length * n
        sequence += times
    return runs


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces``, a written table with a ``length`` column, plus ``sequence_id`` and ``offset``.

    Only the number of pieces of each length, at most ``sequence`` numbers, reaches the driver, and
    only the fillings go back. A piece finds its place by its rank among the pieces of its length.
    Ranks are counted in parts of a length, so that a length that a third of all pieces have is no
    single task's work; a part is chosen by the row's place in the table, so that repeated rows
    spread too. Repeated rows are separate pieces; lengths outside 1 to ``sequence`` are refused; an
    empty table gives none. Columns that are called like the new ones are replaced.
    """
    from pyspark.sql import Window

    pieces = pieces.drop("sequence_id", "offset")
    rows = pieces.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(length is None or not 0 < length <= sequence for length in counts):
        raise ValueError(f"pieces must have 1 to {sequence} tokens")
    runs = slots(best_two_fit(counts, sequence))
    parts = max(PARTS, sum(counts.values()) // PART_ROWS)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_file", "_row"), F.lit(parts)))
    sizes = rows.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")
    sizes = sizes.select("length", "_part", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_file", "_row")) - 1
    ranked = rows.withColumn("_rank", place).join(sizes, ["length", "_part"])
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_rank")).alias("_rank"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tables = {length: tuple(np.array(column) for column in zip(*found)) for length, found in runs.items()}
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("_rank").to_numpy()
            sequences, offsets = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                firsts, times, firsts_of, offset = tables[length]
                run_of = np.searchsorted(firsts, ranks[mine], "right") - 1
                turn = ranks[mine] - firsts[run_of]
                sequences[mine] = firsts_of[run_of] + turn // times[run_of]
                offsets[mine] = offset[run_of] + turn % times[run_of] * length
            kept = [batch.column(name) for name in batch.schema.names if name != "_rank"]
            names = [name for name in batch.schema.names if name != "_rank"]
            columns = [*kept, pa.array(sequences), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def packed(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, digest: bool = True) -> DataFrame:
    """Tokenise and pack. With ``digest`` the ids are replaced by their crc32 before anything moves."""
    pieces = tokenize(docs, tokenizer, sequence)
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(saved(pieces, "packing-pieces"), sequence)
