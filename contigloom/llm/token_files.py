"""Token ids in Arrow stream files of fixed-size lists, and their readers.

Format. A data set is a folder of ``part-*.arrow`` files and a Parquet manifest. Each file is an Arrow
IPC stream of record batches with two columns: ``ids``, fixed_size_list<uint16 or uint32>[seq_len] (uint16
when the vocabulary fits), and ``mask``, fixed_size_list<bool>[seq_len], true where an id is real. All batches
of a file but the last hold batch_seqs sequences, so the place of any id follows from its number
and a memory-mapped file is read without copies. The documents' ids follow one another without gaps; only
a file's last sequence is padded. Files named by the manifest, in order of ``part``, are the data set; what a lost
task left behind is named nowhere.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.llm.chunks import chunks, hashes, lowered, slices
from contigloom.runtime import keep, ship, tidy

MANIFEST = "`{key}` {kind}, part int, file string, first long, n_tokens long"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


_models: dict[str, object] = {}


def load_model(path: str):
    """The tokenizers library's model, one for each worker."""
    if path not in _models:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        _models[path] = model
    return _models[path]


class TextEncoder:
    """Ids of whole texts from the library, for models that keep white space."""

    def __init__(self, path: str, dtype: str):
        self.model, self.dtype = load_model(path), np.dtype(dtype)

    def library(self, text: bytes) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids, self.dtype)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return [self.library(t).tobytes() for t in texts]


class ChunkEncoder(TextEncoder):
    """Ids of texts by way of a table of their white-space-delimited chunks, of a fixed size.

    Exact for models that drop white space and never let a token cross it. A chunk's 128-bit hash names its only slot; a newer chunk takes the slot of an
    older one, and chunks of more ids than a slot holds are not kept, so the table is `slots` times 29 bytes (for 16-bit ids) and no more, whatever is read.
    New chunks go to the library many at a time, as one text with a separator word between them; the separator's byte
    stands in no chunk that is encoded this way.
    """

    SEPARATOR = b"\x01"
    #: Ids that a slot holds, and bytes of text that are worked on at once.
    WIDE, STEP = 6, 1 << 20

    def __init__(self, path: str, dtype: str, slots: int = 1 << 20):
        super().__init__(path, dtype)
        self.first, self.second = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.size, self.ids = np.zeros(slots, np.uint8), np.zeros((slots, self.WIDE), self.dtype)
        between = self.library(self.SEPARATOR)
        self.between = int(between[0]) if len(between) == 1 else None
        self.fine, self.added = _parts_marks(path)

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all these chunks, one after the other, and how many each has."""
        parts, size = [], np.zeros(len(new), np.int64)
        plain = [i for i, w in enumerate(new) if self.between is not None and self.SEPARATOR not in w]
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            ids = self.library((b" " + self.SEPARATOR + b" ").join([new[i] for i in some]))
            cut = ids == self.between
            size[some] = np.diff(np.concatenate([[-1], np.flatnonzero(cut), [len(ids)]])) - 1
            parts.append(ids[~cut])
        if len(plain) == len(new):
            return np.concatenate(parts), size
        known = dict(zip(plain, np.split(np.concatenate([np.zeros(0, self.dtype), *parts]), np.cumsum(size[plain])[:-1])))
        each = [known[i] if i in known else self.library(w) for i, w in enumerate(new)]
        return np.concatenate(each), np.array([len(x) for x in each])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out, start, held = [], 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= self.STEP or i == len(texts) - 1:
                out += self._encode(texts[start : i + 1])
                start, held = i + 1, 0
        return out

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        cut = False
        if self.fine:
            low = [lowered(t) for t in texts]
            cut = not any(x in t for t in low for x in self.added)
        raw, start, end, first = chunks(low if cut else texts, cut)
        a, b = hashes(raw, start, end, 0), hashes(raw, start, end, 1)
        slot = (a % np.uint64(len(self.size))).astype(np.int64)
        hit = (self.first[slot] == a) & (self.second[slot] == b)
        count = np.where(hit, self.size[slot], 0).astype(np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            _, at, back = np.unique(a[miss], return_index=True, return_inverse=True)
            if (b[miss] != b[miss[at]][back]).any():  # two chunks of one first hash: take every place by itself
                at = back = np.arange(len(miss))
            one = miss[at]
            flat, size = self._learn([raw[s:e] for s, e in zip(start[one].tolist(), end[one].tolist())])
            begin = np.cumsum(size) - size
            count[miss] = size[back]
        ends = np.cumsum(count)
        place = ends - count
        ids = np.empty(int(ends[-1]) if len(ends) else 0, self.dtype)
        left = np.flatnonzero(hit)
        for j in range(self.WIDE):
            left = left[count[left] > j]
            ids[place[left] + j] = self.ids[slot[left], j]
        if len(miss):
            n = count[miss]
            run = np.arange(int(n.sum()))
            shift = np.cumsum(n) - n
            ids[np.repeat(place[miss] - shift, n) + run] = flat[np.repeat(begin[back] - shift, n) + run]
            short = np.flatnonzero(size <= self.WIDE)
            where, own = np.unique(slot[one[short]], return_index=True)
            own = short[own]
            self.first[where], self.second[where], self.size[where] = a[one[own]], b[one[own]], size[own]
            for j in range(self.WIDE):
                some = size[own] > j
                self.ids[where[some], j] = flat[begin[own[some]] + j]
        bounds = np.concatenate([[0], ends])[first].tolist()
        return [ids[s:e].tobytes() for s, e in zip(bounds, bounds[1:])]


_encoders: dict[tuple, TextEncoder] = {}


def encoder_for(path: str, dtype: str, whole: bool) -> TextEncoder:
    """One encoder for all tasks of a worker, of a fixed size."""
    if (path, dtype, whole) not in _encoders:
        _encoders.clear()
        _encoders[path, dtype, whole] = (TextEncoder if whole else ChunkEncoder)(path, dtype)
    return _encoders[path, dtype, whole]


def _keeps_space(step: dict) -> bool:
    """Whether a pre-tokenizer may put white space into a piece."""
    if step.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return False
    if step.get("type") != "Split" or step.get("behavior") != "Removed" or not step.get("invert") or "Regex" not in step["pattern"]:
        return True
    import regex

    pattern = regex.compile(step["pattern"]["Regex"])
    probes = [f"{x}{c * n}{y}" for c in "\t\n\x0b\x0c\r " for n in (1, 2, 5) for x in ("", "a", "É", "7", ".", "'", "_") for y in ("", "b", "s", "8", "!", "'", "_")]
    return any(not set(m[0]).isdisjoint("\t\n\x0b\x0c\r ") for p in probes for m in pattern.finditer(p))


#: Fixed values of a known model: its steps before the vocabulary, under which the pieces of letters and of punctuation do not depend on one another.
KNOWN_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
KNOWN_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _parts_marks(path: str) -> tuple[bool, list[bytes]]:
    """(whether the model is one of the known description, its added tokens)."""
    told = json.loads(load_model(path).to_str())
    steps = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    known = (told.get("normalizer") or {}).get("normalizers") == KNOWN_NORMALIZER and steps[0].get("pattern") == {"Regex": KNOWN_PIECES} and [x.get("type") for x in steps[1:]] == ["ByteLevel"] and not steps[1].get("use_regex")
    return known, [x["content"].lower().encode() for x in told.get("added_tokens") or []]


def drops_white_space(path: str) -> bool:
    """Whether chunks can be encoded one by one: the model's description says that ASCII white space parts pieces and is dropped, and a probe agrees.

    Trusted are a first pre-tokenizer whose pieces hold no white space, normalizers that work on single characters or on white space
    alone, and added tokens without white space or a claim on that around them. All other models get whole texts.
    """
    told = json.loads(load_model(path).to_str())
    steps = told.get("pre_tokenizer") or {}
    normal = told.get("normalizer") or {}
    inner = [x for x in (normal.get("normalizers") or [normal]) if x.get("type") not in (None, "NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer")]
    plain = all(x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " " for x in inner)
    plain &= not _keeps_space((steps.get("pretokenizers") or [steps])[0])
    plain &= not any(any(c.isspace() for c in x["content"]) or x.get("lstrip") or x.get("rstrip") for x in told.get("added_tokens") or [])
    both, alone, other = (load_model(path).encode(x, add_special_tokens=False).ids for x in ("ab  \n cd", "ab", "cd"))
    return plain and both == alone + other


class SequenceWriter:
    """Packs id bytes into equal sequences and writes them batch by batch."""

    def __init__(self, path: str, dtype: np.dtype, seq_len: int, batch_seqs: int):
        self.fs, self.path = open_fs(path)
        self.dtype, self.seq_len, self.step = dtype, seq_len, seq_len * batch_seqs
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))], metadata={"seq_len": str(seq_len), "batch_seqs": str(batch_seqs)})
        self.sink = self.fs.open_output_stream(self.path)
        self.out = ipc.new_stream(self.sink, self.schema)
        self.held, self.n_held, self.n = [], 0, 0

    def add(self, ids: bytes) -> int:
        """Returns the number of ids before these."""
        first, n = self.n, len(ids) // self.dtype.itemsize
        self.held.append(ids)
        self.n += n
        self.n_held += n
        if self.n_held >= self.step:
            self._write(False)
        return first

    def _write(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), self.dtype)
        end = len(flat) if last else len(flat) // self.step * self.step
        for i in range(0, end, self.step):
            part = flat[i : min(i + self.step, end)]
            real = len(part)
            if pad := -real % self.seq_len:
                part = np.concatenate([part, np.zeros(pad, self.dtype)])
            mask = np.arange(len(part)) < real
            self.out.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(part), self.seq_len), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.seq_len)], schema=self.schema))
        self.held, self.n_held = [flat[end:].tobytes()], len(flat) - end

    def close(self) -> None:
        self._write(True)
        self.out.close()
        self.sink.close()


class TokenFile:
    """Random access to one file; local files are memory-mapped and never copied as a whole."""

    def __init__(self, path: str):
        where, name = open_fs(path)
        self.source = pa.memory_map(name) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(name)
        reader = ipc.open_stream(self.source)
        self.seq_len, self.batch_seqs = (int(reader.schema.metadata[k]) for k in (b"seq_len", b"batch_seqs"))
        self.batches = list(reader)
        self.flat = [b.column(0).flatten().to_numpy(zero_copy_only=True) for b in self.batches]

    def sequence(self, i: int) -> np.ndarray:
        b, at = divmod(i, self.batch_seqs)
        return self.flat[b][at * self.seq_len : (at + 1) * self.seq_len]

    def mask(self, i: int) -> np.ndarray:
        b, at = divmod(i, self.batch_seqs)
        return self.batches[b].column(1)[at].values.to_numpy(zero_copy_only=False)

    def slice(self, first: int, n: int) -> np.ndarray:
        """n ids from the first on; a view when they lie in one batch."""
        step, parts = self.seq_len * self.batch_seqs, []
        while n > 0:
            b, at = divmod(first, step)
            parts.append(self.flat[b][at : at + n])
            first, n = first + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, self.flat[0].dtype if self.flat else np.uint16)])


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text", seq_len: int = 2048, batch_seqs: int = 128, file_ids: int = 1 << 26) -> DataFrame:
    """Encode the whole texts in ascending key order into files in folder; the manifest, one row per document.

    The texts are range-partitioned by key (the only shuffle) and sorted inside each task, which streams them to files of
    its own, a new one after the document that fills file_ids. Rows of equal key are ordered by text; null keys come first; a null text gives the end id alone; an empty
    table gives no file and an empty manifest. Manifest: key, part, file, first (ids before it in its file), n_tokens.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = max(load_model(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    whole = not drops_white_space(tokenizer)
    kind = docs.schema[key].dataType.simpleString()
    run_id = uuid.uuid4().hex[:8]
    where, name = open_fs(folder)
    where.create_dir(name, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, task = encoder_for(tokenizer, dtype, whole), None, TaskContext.get()
        end = np.array([end_id], dtype).tobytes()
        part = task.partitionId()
        rolled, names = 0, [key, "part", "file", "first", "n_tokens"]
        for b in batches:
            for s in slices(b, 1, 1024, 4 << 20):
                ids = [x + end for x in encoder.encode(s.column(1).cast(pa.binary()).to_pylist())]
                files, first = [], []
                for x in ids:
                    if writer is not None and writer.n >= file_ids:
                        writer.close()
                        writer = None
                    if writer is None:
                        path = f"{folder}/part-{part:06d}-{run_id}-{task.taskAttemptId()}-{rolled:06d}.arrow"
                        writer, rolled = SequenceWriter(path, np.dtype(dtype), seq_len, batch_seqs), rolled + 1
                    files.append(path)
                    first.append(writer.add(x))
                sizes = [len(x) // len(end) for x in ids]
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(files), pa.array(first, pa.int64()), pa.array(sizes, pa.int64())], names=names)
        if writer is not None:
            writer.close()

    ordered = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text)).repartitionByRange(key).sortWithinPartitions(key, text)
    return keep(ordered.mapInArrow(tidy(run), MANIFEST.format(key=key, kind=kind)), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds start: ids of all documents before it in the data set. The window runs over one row per file."""
    ends = manifest.groupBy("part", "file").agg(F.sum("n_tokens").alias("_n"))
    base = ends.select("part", "file", (F.sum("_n").over(Window.orderBy("part", "file")) - F.col("_n")).alias("_base"))
    return manifest.join(base, ["part", "file"]).withColumn("start", F.col("_base") + F.col("first")).drop("_base")


def read_digests(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids_crc32 and part, from the files: each document's ids are sliced out of its memory-mapped file."""
    ship(manifest.sparkSession)
    kind = manifest.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for b in batches:
            crc, n_read = [], []
            for path, first, n in zip(*(b.column(i).to_pylist() for i in (3, 4, 2))):
                if path != name:
                    name, file = path, TokenFile(path)
                ids = file.slice(first, n)
                n_read.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_read, pa.int64()), pa.array(crc, pa.int64()), b.column(5)], names=[key, "start", "n_tokens", "ids_crc32", "part"])

    rows = with_starts(manifest).select(key, "start", "n_tokens", "file", "first", "part")
    return rows.mapInArrow(tidy(run), f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long, part int")
