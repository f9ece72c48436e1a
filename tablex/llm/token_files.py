"""Token-id files: documents in ascending id order, tokenised and range-coded in independent, checksummed blocks.

Layout of a file: frames one after another, a line end behind each. A frame is

    "TXF2" | bytes that follow (u32) | documents (u32) | blocks (u32) | bytes of order 0 (u32)
    | for each document: has an id (u8), id (i64), tokens (u64)
    | for each block: tokens (u32), crc32 of its ids as little-endian u32 (u32), coded bytes (u32)
    | order 0: how often each id occurs in the frame (`rangecoder.Order0`)
    | the coded blocks

and holds whole documents; a block holds `BLOCK` ids (the last of a frame fewer) and starts the coder anew. All
numbers are little-endian. Files are written by Spark's text writer, so they can lie on any storage
that Spark can write, and are read as binary files. Vocabularies of up to 65,536 ids are supported.

Documents are range-partitioned and sorted by id (NULL first), then by a hash of the text. NULL and empty texts are
encoded as the end id alone. Rows alike are written once each. Ids must be integers.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablex.llm.batches import in_arrow
from tablex.llm import rangecoder
from tablex.llm.common import table
from tablex.session import stored, work_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"TXF2"
BLOCK = rangecoder.BLOCK
FRAME_IDS = BLOCK * rangecoder.LANES
#: Words whose ids a Python worker remembers, and chunks that are not a word and marks (about 200 bytes each).
WORDS, CHUNKS = 500_000, 50_000
#: Frames of a file: of about 4 MB each, unless a single document has more.
FRAMES = 16


class Encoder:
    """Ids of whole texts by chunks between ASCII white space, where the vocabulary lets no token cross it.

    The ids of a chunk are those the tokenizer gives for it alone. A chunk of letters followed by ASCII marks (no
    apostrophe) is put together from its word and its marks, if the tokenizer splits there: only letters
    that its own normaliser leaves letters count as such (İ becomes i and a mark of its own). Words new
    to this worker are encoded many in one text: the last token of each word is marked in the vocabulary.
    Words that normalising and splitting leave as they are go to the tokenizer's model with no more
    than a split at blanks before it, if that gives the same ids for words of all such letters.
    A vocabulary that joins tokens over white space, or words and marks, is given whole texts or whole chunks.
    """

    LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x250))]
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) > 0xFFFF:
            raise ValueError("token files hold ids below 65,536")
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        simple = [c for c in self.LETTERS if c.isalpha() and normal(c).isalpha()]
        self.lowers = all(normal(c) == normal(c.lower()) for c in simple if c.isascii()) and normal("".join(simple)) == "".join(map(normal, simple))
        joined = lambda *parts: self.direct(["".join(parts)])[0] == b"".join(self.direct([*parts]))
        self.by_chunk = all(joined(a, f"{blank}{b}") and self.direct([f"{blank}{b}"]) == self.direct([b]) for blank in " \t\n\v\f\r" for a, b in (("word", "next"), ("a,", "1"), ("é", "b")))
        split = self.by_chunk and all(joined("word", mark) and joined("é", mark * 2) for mark in self.MARKS)
        self.simple = f"^[{''.join(simple)}]+$" if split and simple else None
        plain = [c for c in simple if split and normal(c) == c]
        self.plain, self.bare = re.compile(f"[{''.join(plain)}]+" if plain else "(?!)"), Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        tried = [*plain, *map("".join, zip(plain, plain[1:] + plain[:1])), *map("".join, zip(plain, plain[::-1], plain)), "".join(plain), "".join(plain[::-1])]
        if plain and self.direct(tried) != self.direct(tried, self.bare):
            self.plain = re.compile("(?!)")

    def direct(self, texts: list[str], tokenizer=None) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def several(self, words: list[bytes], tokenizer, together: int = 100) -> Iterator[bytes]:
        """Ids of words, each of which the tokenizer takes for one."""
        for at in range(0, len(words), together):
            some = words[at : at + together]
            ids = np.frombuffer(self.direct([b" ".join(some).decode()], tokenizer)[0], "<u2")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                yield from self.direct([w.decode() for w in some], tokenizer)
                continue
            data, bounds = ids.tobytes(), [0, *(2 * ends).tolist()]
            yield from [data[start:end] for start, end in zip(bounds, bounds[1:])]

    def texts(self, texts: pa.Array | list[bytes | None]) -> list[bytes]:
        """Ids of each text (UTF-8) as little-endian u16; every different chunk of the texts is looked up once."""
        texts = pa.array(texts, pa.binary())
        if not self.by_chunk:
            return self.direct([(t or b"").decode("utf-8", "replace") for t in texts.to_pylist()])
        if len(self.chunks) > CHUNKS:
            self.chunks.clear()
        split = pc.ascii_split_whitespace(texts.view(pa.string()))  # at the six white characters of ASCII
        places = split.flatten().dictionary_encode()
        different, places = self.different(places.dictionary), places.indices.to_numpy()
        sizes = np.fromiter(map(len, different), np.int64, len(different)) // 2
        starts, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(different), "<u2")
        ends = np.append(0, np.cumsum(sizes[places]))  # of the chunks' ids, all texts behind one another
        ids = np.empty(ends[-1], "<u2")
        for k in range(0, len(places), 100_000):
            some, until = places[k : k + 100_000], ends[k : k + 100_001]
            ids[until[0] : until[-1]] = data[np.repeat(starts[some] - until[:-1], sizes[some]) + np.arange(until[0], until[-1])]
        chunks = np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False))
        bounds = ends[np.append(0, chunks)].tolist()
        return [ids[start:end].tobytes() for start, end in zip(bounds, bounds[1:])]

    def different(self, chunks: pa.Array) -> list[bytes]:
        """Ids of each of the chunks, which all differ."""
        words = pc.ascii_rtrim(chunks, characters=self.MARKS)
        odd = np.ones(len(chunks), bool) if self.simple is None else ~pc.match_substring_regex(words, self.simple).to_numpy(zero_copy_only=False)
        places = (pc.ascii_lower(words) if self.lowers else words).filter(pa.array(~odd)).dictionary_encode()
        ids = self.known(objects(places.dictionary))
        out = np.empty(len(chunks), object)
        out[~odd] = np.array([*ids, None], object)[:-1][places.indices.to_numpy()]
        ends = np.flatnonzero((pc.binary_length(chunks).to_numpy() > pc.binary_length(words).to_numpy()) & ~odd)
        if len(ends):
            starts = pc.binary_length(words).to_numpy()[ends].tolist()
            marks = [c[n:] for c, n in zip(objects(chunks.take(pa.array(ends))), starts)]
            different = [*dict.fromkeys(marks)]
            after = dict(zip(different, self.known(different)))
            out[ends] = [a + after[m] for a, m in zip(out[ends].tolist(), marks)]
        raw = objects(chunks.filter(pa.array(odd)))
        new = [c for c in raw if c not in self.chunks]
        self.chunks.update(zip(new, self.direct([c.decode("utf-8", "replace") for c in new])))
        for k, c in zip(np.flatnonzero(odd).tolist(), raw):
            out[k] = self.chunks[c]
        return out.tolist()

    def known(self, words: list[bytes]) -> list[bytes]:
        """Ids of words and marks; those not met lately are encoded."""
        if len(self.words) > WORDS // 2:
            self.words, self.older = {}, self.words
        found, older, plain, others = [*map(self.words.get, words)], self.older, [], []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            word = words[k]
            ids = older.get(word)
            if ids is None:
                (plain if self.plain.fullmatch(word.decode()) else others).append(k)
            else:
                found[k] = self.words[word] = ids
        for places, tokenizer in ((plain, self.bare), (others, self.tokenizer)):
            for k, ids in zip(places, self.several([words[k] for k in places], tokenizer)):
                found[k] = self.words[words[k]] = ids
        return found


def objects(texts: pa.Array) -> list[bytes]:
    return texts.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def encoder_of(definition: str) -> Encoder:
    """The encoder of this Python worker, kept between tasks."""
    kept = sys.__dict__.setdefault("_token_encoders", {})
    key = zlib.crc32(definition.encode())
    if key not in kept:
        kept.clear()
        kept[key] = Encoder(definition)
    return kept[key]


def frame(docs: list[tuple[int | None, bytes]]) -> bytes:
    """A frame of (id, ids as u16) documents."""
    ids = np.frombuffer(b"".join(body for _, body in docs), "<u2")
    coded, heads = [], []
    order0 = rangecoder.Order0.of(ids)
    for first, end in together(-(-len(ids) // BLOCK)):
        part = ids[first * BLOCK : end * BLOCK]
        steps = min(BLOCK, len(part))
        rows = np.append(part, np.repeat(part[-1:], -len(part) % steps)).reshape(-1, steps)
        for k, data in enumerate(rangecoder.encode(rows, order0)):
            plain = part[k * BLOCK : (k + 1) * BLOCK]
            coded.append(data)
            heads.append(struct.pack("<III", len(plain), zlib.crc32(plain.astype("<u4").tobytes()), len(data)))
    entries = [struct.pack("<BqQ", doc is not None, doc or 0, len(body) // 2) for doc, body in docs]
    shares = order0.dump()
    rest = b"".join([struct.pack("<III", len(docs), len(heads), len(shares)), *entries, *heads, shares, *coded])
    return MAGIC + struct.pack("<I", len(rest)) + rest


def together(blocks: int) -> Iterator[tuple[int, int]]:
    """First and end of the blocks that are coded side by side: about `LANES`, so that no few are left."""
    size = -(-blocks // max(1, round(blocks / rangecoder.LANES)))
    yield from ((k, min(k + size, blocks)) for k in range(0, blocks, max(size, 1)))


def frames(content: bytes) -> Iterator[tuple[list[tuple[int | None, int]], np.ndarray]]:
    """(documents with their number of ids, all ids) of each frame; every block is held against its checksum."""
    at = 0
    while at < len(content):
        if content[at : at + 4] != MAGIC:
            raise ValueError("not a token file")
        size, n_docs, n_blocks, n_shares = struct.unpack_from("<IIII", content, at + 4)
        place = at + 20
        docs = [(doc if there else None, n) for there, doc, n in struct.iter_unpack("<BqQ", content[place : place + 17 * n_docs])]
        place += 17 * n_docs
        heads = [*struct.iter_unpack("<III", content[place : place + 12 * n_blocks])]
        place += 12 * n_blocks
        order0 = rangecoder.Order0.load(content[place : place + n_shares])
        place += n_shares
        parts = []
        for first, end in together(n_blocks):
            some, coded = heads[first:end], []
            for _, _, length in some:
                coded.append(content[place : place + length])
                place += length
            for (n, check, _), row in zip(some, rangecoder.decode(coded, some[0][0], order0)):
                ids = row[:n].astype("<u4")
                if zlib.crc32(ids.tobytes()) != check:
                    raise ValueError("a block of a token file is damaged")
                parts.append(ids)
        yield docs, np.concatenate(parts) if parts else np.zeros(0, "<u4")
        at += 8 + size + 1


def write_tokens(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Writes the documents' token files; the vocabulary file is read once and sent to the executors."""
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).cast("long").alias("t_id"), F.col(text).cast("binary").alias("t_text"), F.xxhash64(text).alias("t_hash"))
    rows = rows.repartitionByRange("t_id", "t_hash").sortWithinPartitions("t_id", "t_hash").drop("t_hash")

    def write(batches):
        encoder, end = encoder_of(definition.value), np.array([end_id], "<u2").tobytes()
        held: list[tuple[int | None, bytes]] = []
        size = 0
        for batch in batches:
            for doc, body in zip(batch.column("t_id").to_pylist(), encoder.texts(batch.column("t_text"))):
                held.append((doc, body + end))
                size += len(body) // 2 + 1
                if size >= FRAME_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array([frame(held)], pa.binary())], names=["frame"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([frame(held)], pa.binary())], names=["frame"])

    # The writer takes text; the cast leaves the bytes as they are.
    in_arrow(rows, write, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", FRAMES).text(folder)


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(t_id, t_start, t_n, t_crc, t_ids) of every document; t_start counts the ids of all documents before it."""

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                before, place = 0, 0
                for docs, all_ids in frames(content.as_py()):
                    ends = np.cumsum([n for _, n in docs])
                    bodies = [all_ids[e - n : e] for (_, n), e in zip(docs, ends)]
                    columns = [
                        pa.array([path] * len(docs), pa.string()),
                        pa.array(range(place, place + len(docs)), pa.int64()),
                        pa.array([d for d, _ in docs], pa.int64()),
                        pa.array([before + int(e) - n for (_, n), e in zip(docs, ends)], pa.int64()),
                        pa.array([n for _, n in docs], pa.int64()),
                        pa.array([zlib.crc32(b.tobytes()) for b in bodies], pa.int64()),
                        pa.array([b.astype(np.int32) for b in bodies] if ids else [None] * len(docs), pa.list_(pa.int32())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["t_file", "t_place", "t_id", "t_at", "t_n", "t_crc", "t_ids"])
                    before, place = before + int(ends[-1]), place + len(docs)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    found = stored(in_arrow(files, read, "t_file string, t_place long, t_id long, t_at long, t_n long, t_crc long, t_ids array<int>"), "tokens")
    totals = found.groupBy("t_file").agg(F.sum("t_n").alias("t_total"))  # one row per file
    number = F.regexp_extract("t_file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(number, "t_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("t_file", F.coalesce(F.sum("t_total").over(earlier), F.lit(0)).alias("t_before"))
    return found.join(starts, "t_file").select("t_id", (F.col("t_before") + F.col("t_at")).alias("t_start"), "t_n", "t_crc", "t_ids")


def tokenised(spark: SparkSession, docs: DataFrame, **kwargs) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from files written for it and read back."""
    folder = f"{work_folder(spark, 'token_files')}/files"
    write_tokens(docs, folder, **kwargs)
    found = read_tokens(spark, folder, ids=False)
    return found.select(F.col("t_id").alias("doc_id"), F.col("t_start").alias("start"), F.col("t_n").alias("n_tokens"), F.col("t_crc").alias("ids_crc32"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenised(spark, table(spark, folder, "documents"))


QUERIES = {"op6_token_files": op6_token_files}
ORACLES: dict[str, str] = {}
