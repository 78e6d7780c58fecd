"""SentencePiece BPE: encoding by vectorised merge rounds, and decoding.

A text is cut wherever no piece of the vocabulary holds the two characters side by side: no merge can cross such a
place, so the words between are independent and equal ones are encoded once. The distinct words of a batch lie in one
flat array of symbols. A round finds the least pair rank of every word (a segmented minimum), merges the leftmost pair
of that rank in every word at once, and closes the gaps; words leave when no pair is left.

The library merges one pair at a time, the best score first and the leftmost of equals. Merging all pairs of a word's
least rank in one round gives the same, unless a piece just made can at once be part of a pair that is no worse. Those
pieces are known from the vocabulary (`restless`); with them a word merges its leftmost pair alone.
A word of more than LONG symbols keeps minima per stretch of it, so that a merge costs one stretch, not the word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.wordscan import batches

SPACE = "▁"
BATCH_CHARS = 1 << 20
CACHE_WORDS = 1 << 17
LONG = 4096
STRETCH = 256
NO_RANK = np.int64(1 << 62)


@dataclass
class Vocabulary:
    """Arrays of one model. Symbols are piece ids, then characters that only occur within pieces, then -1 for all others."""

    pieces: list[bytes]  # surface of each id as the decoder writes it; empty for controls
    kinds: np.ndarray  # 0 piece, 1 control, 2 byte, 3 unknown
    bytes_: np.ndarray  # id of each byte's piece, -1 without byte fallback
    unknown: int
    bos: int
    eos: int
    chars: np.ndarray  # code points, sorted
    char_symbol: np.ndarray
    neighbours: np.ndarray  # a << 21 | b of characters side by side in a piece, sorted
    pairs: np.ndarray  # left * width + right, sorted
    merged: np.ndarray
    rank: np.ndarray  # of each pair
    restless: np.ndarray  # of each piece
    width: int


def vocabulary(path: str) -> Vocabulary:
    """Read a BPE model whose normalizer changes nothing but blanks; others raise ValueError."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec, kind = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
    plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
    if not plain or model.trainer_spec.model_type != model.trainer_spec.BPE or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: not a BPE model with an identity normalizer and a leading blank")
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
        raise ValueError(f"{path}: pieces that the user defined or that are unused")
    n = len(model.pieces)
    score = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
    symbol = dict(ids)
    for p in ids:
        for c in p:
            symbol.setdefault(c, len(symbol) - len(ids) + n)
    worth = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
    width = n + len(symbol)
    rows, restless = [], np.zeros(width, dtype=bool)
    for p, i in ids.items():
        own = worth[score[p]]
        for cut in range(1, len(p)):
            left, right = symbol.get(p[:cut]), symbol.get(p[cut:])
            if left is None or right is None:
                continue
            rows.append((left * width + right, i, own))
            for part in (p[:cut], p[cut:]):
                if len(part) > 1 and worth[score[part]] >= own:
                    restless[ids[part]] = True
    pairs, merged, rank = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3).T
    near = {ord(a) << 21 | ord(b) for p in ids for a, b in zip(p, p[1:])}
    chars = sorted((ord(c), s) for c, s in symbol.items() if len(c) == 1)
    kinds = np.array([{kind.CONTROL: 1, kind.BYTE: 2, kind.UNKNOWN: 3}.get(p.type, 0) for p in model.pieces], dtype=np.int8)
    byte_ids = np.full(256, -1, dtype=np.int32)
    surface = []
    for i, p in enumerate(model.pieces):
        if kinds[i] == 2:
            byte_ids[int(p.piece[3:5], 16)] = i
            surface.append(bytes([int(p.piece[3:5], 16)]))
        else:
            surface.append({0: p.piece.replace(SPACE, " "), 1: "", 3: model.trainer_spec.unk_surface}[kinds[i]].encode())
    unknown = int(np.flatnonzero(kinds == 3)[0])
    if not model.trainer_spec.byte_fallback:
        byte_ids[:] = -1
    c, s = np.array(chars, dtype=np.int64).T
    return Vocabulary(surface, kinds, byte_ids, unknown, model.trainer_spec.bos_id, model.trainer_spec.eos_id, c, s, np.array(sorted(near), dtype=np.int64), pairs.copy(), merged.copy(), rank.copy(), restless, width)


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each key in a sorted table."""
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


def words(vocab: Vocabulary, text: str) -> list[str]:
    """Stretches of the text, blanks written as the vocabulary writes them, that no piece can reach across."""
    if not text:
        return []
    text = SPACE + text.replace(" ", SPACE)
    p = points(text)
    _, near = found(vocab.neighbours, p[:-1] << 21 | p[1:])
    cuts = [0, *(np.flatnonzero(~near) + 1).tolist(), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def symbols(vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    at, known = found(vocab.chars, p)
    return np.where(known, vocab.char_symbol[at], -1)


def ranked(vocab: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, symbol made) of each pair; NO_RANK where the two make no piece."""
    at, known = found(vocab.pairs, left * vocab.width + right)
    known &= (left >= 0) & (right >= 0)
    return np.where(known, vocab.rank[at], NO_RANK), np.where(known, vocab.merged[at], -1)


def merged_words(vocab: Vocabulary, given: list[str]) -> list[bytes]:
    """Ids of each word, as little-endian 32-bit integers."""
    p = points("".join(given))
    word = np.repeat(np.arange(len(given)), [len(w) for w in given])
    sym, char = symbols(vocab, p), p  # char: the code point that a symbol of one character stands for
    done_word, done_sym, done_char = [], [], []
    rank, made = ranked(vocab, sym[:-1], sym[1:])
    rank[word[1:] != word[:-1]] = NO_RANK
    rank, made = np.append(rank, NO_RANK), np.append(made, -1)
    while len(sym):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
        over = least == NO_RANK
        if over.any():
            done_word.append(word[over]), done_sym.append(sym[over]), done_char.append(char[over])
            live = ~over
            sym, char, word, rank, made, least = sym[live], char[live], word[live], rank[live], made[live], least[live]
            if not len(sym):
                break
        hit = rank == least
        at = np.flatnonzero(hit)
        first = np.append(True, word[at][1:] != word[at][:-1])
        run = np.append(True, np.diff(at) != 1) | first
        begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        chosen = (np.arange(len(at)) - begin) % 2 == 0  # of pairs that share a symbol the left one
        at = at[first | (chosen & ~vocab.restless[made[at]])]
        sym[at] = made[at]
        stay = np.ones(len(sym), dtype=bool)
        stay[at + 1] = False
        fresh = np.zeros(len(sym), dtype=bool)
        fresh[at] = True
        fresh[at[at > 0] - 1] = True
        fresh[np.maximum(at - 2, 0)[~stay[np.maximum(at - 1, 0)]]] = True  # the left neighbour may itself be a pair just merged
        sym, char, word, rank, made, fresh = sym[stay], char[stay], word[stay], rank[stay], made[stay], fresh[stay]
        f = np.flatnonzero(fresh)
        inner = f[f < len(sym) - 1]
        rank[f], made[f] = NO_RANK, -1
        inner = inner[word[inner] == word[inner + 1]]
        rank[inner], made[inner] = ranked(vocab, sym[inner], sym[inner + 1])
    word, sym, char = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (done_word, done_sym, done_char))
    order = np.argsort(word, kind="stable")
    ids, counts = written(vocab, sym[order], char[order])
    ends = np.cumsum(np.bincount(word, weights=counts[np.argsort(order, kind="stable")], minlength=len(given)).astype(np.int64))
    raw = ids.astype("<u4").tobytes()
    return [raw[4 * a : 4 * b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


def merged_long(vocab: Vocabulary, given: str) -> bytes:
    """merged_words for one long word: a merge looks for the least rank among minima of stretches and mends the stretch it changes."""
    char = points(given)
    n = len(char)
    size = -(-n // STRETCH) * STRETCH
    sym = symbols(vocab, char)
    rank, made = np.full(size, NO_RANK), np.full(size, -1)
    rank[: n - 1], made[: n - 1] = ranked(vocab, sym[:-1], sym[1:])
    after, before, live = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, dtype=bool)
    table = rank.reshape(-1, STRETCH)
    least = table.min(axis=1)
    where = {int(k): (int(r), int(m)) for k, r, m in zip(vocab.pairs, vocab.rank, vocab.merged)}
    while True:
        block = int(least.argmin())
        if least[block] == NO_RANK:
            break
        i = block * STRETCH + int(table[block].argmin())
        j = int(after[i])
        sym[i], live[j] = made[i], False
        after[i] = k = int(after[j])
        rank[j] = NO_RANK
        if k < n:
            before[k] = i
        touched = {block, j // STRETCH}
        for a, b in ((int(before[i]), i), (i, k)):
            if a >= 0:
                best = where.get(int(sym[a]) * vocab.width + int(sym[b])) if b < n and sym[a] >= 0 and sym[b] >= 0 else None
                rank[a], made[a] = best or (NO_RANK, -1)
                touched.add(a // STRETCH)
        for b in touched:
            least[b] = table[b].min()
    return written(vocab, sym[live], char[live])[0].astype("<u4").tobytes()


def written(vocab: Vocabulary, sym: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per symbol): characters that are no piece become the ids of their bytes, or the unknown id."""
    strange = (sym < 0) | (sym >= len(vocab.pieces))
    if not strange.any():
        return sym, np.ones(len(sym), dtype=np.int64)
    own = {c: vocab.bytes_[list(chr(c).encode("utf-8", "replace"))] for c in np.unique(char[strange]).tolist()}
    own = {c: v if (v >= 0).all() else np.array([vocab.unknown]) for c, v in own.items()}
    counts = np.ones(len(sym), dtype=np.int64)
    parts = [own[c] for c in char[strange].tolist()]
    counts[strange] = [len(x) for x in parts]
    out = np.empty(counts.sum(), dtype=np.int64)
    mark = np.repeat(strange, counts)
    out[mark], out[~mark] = np.concatenate(parts), sym[~strange]
    return out, counts


def encode(vocab: Vocabulary, texts: list[str], cache: dict[str, bytes]) -> list[bytes]:
    """Ids of each text without begin and end, as little-endian 32-bit integers. `cache` keeps short words from call to call."""
    cut = [words(vocab, t) for t in texts]
    if len(cache) > CACHE_WORDS:
        cache.clear()
    new = sorted({w for ws in cut for w in ws if w not in cache})
    short, long = [w for w in new if len(w) <= LONG], {w: merged_long(vocab, w) for w in new if len(w) > LONG}
    cache.update(zip(short, merged_words(vocab, short)))
    return [b"".join([cache[w] if len(w) <= LONG else long[w] for w in ws]) for ws in cut]


def decode(vocab: Vocabulary, ids: Iterable[int]) -> str:
    """The text that the library's decoder writes: begin and end vanish, one leading blank goes, stray bytes become U+FFFD."""
    ids = np.asarray(ids, dtype=np.int64)
    kinds = vocab.kinds[ids]
    parts = [vocab.pieces[i] for i in ids.tolist()]
    shown = np.flatnonzero(kinds != 1)
    if len(shown) and kinds[shown[0]] == 0:
        parts[shown[0]] = parts[shown[0]].removeprefix(b" ")
    if not len(shown) or len(shown) == shown[-1] - shown[0] + 1:  # no control between bytes that might seem one character
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            pass
    out, run = [], b""
    for k, part in zip(kinds.tolist(), parts):
        if k == 2:
            run += part
        else:
            out += [strays(run), part.decode()]
            run = b""
    return "".join([*out, strays(run)])


def strays(run: bytes) -> str:
    """Bytes as text, each byte that belongs to no character as U+FFFD."""
    out = []
    while run:
        for n in range(1, 5):
            try:
                out.append(run[:n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out.append("�")
        run = run[n:]
    return "".join(out)


def text_batches(tables: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows with their texts, null as empty, about BATCH_CHARS at a time; a longer text stands alone."""
    for t in tables:
        texts = [x or "" for x in t.column(column).to_pylist()]
        for a, b in batches([len(x) for x in texts], BATCH_CHARS):
            yield t.slice(a, b - a), texts[a:b]


def encoded(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", packed: bool = False) -> DataFrame:
    """All columns of docs but `ids`, and `ids`: array<int> with begin and end, or packed as little-endian 32-bit integers.

    A null or empty text gives begin and end alone. Nothing is cut or left out: texts of any length are encoded whole.
    The rows stay where they are read, so repeated rows, hot sources and long texts need no shuffle. The driver reads
    the model once and sends its arrays (some megabytes, bounded by the vocabulary) to the executors.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(model))
    rows = docs.drop(ids)

    def run(tables):
        v, cache = vocab.value, {}
        begin, end = (np.array([i], dtype="<u4").tobytes() for i in (v.bos, v.eos))
        for t, texts in text_batches(tables, text):
            raw = [begin + x + end for x in encode(v, texts, cache)]
            if packed:
                made = pa.array(raw, pa.binary())
            else:
                flat = np.frombuffer(b"".join(raw), dtype="<i4")
                made = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in raw)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*t.columns, made], names=[*t.schema.names, ids])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, `{ids}` {'binary' if packed else 'array<int>'}")


def decoded(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded", drop: tuple[str, ...] = ()) -> DataFrame:
    """All columns of rows but `text` and those to drop, and `text`: what the ids, an array or packed, stand for. Null ids give null."""
    vocab = rows.sparkSession.sparkContext.broadcast(vocabulary(model))
    kept = [c for c in rows.columns if c != text and c not in drop]
    packed = rows.schema[ids].dataType.simpleString() == "binary"

    def run(tables):
        v = vocab.value
        for t in tables:
            column = t.column(t.schema.names.index(ids))
            lists = (np.frombuffer(x.as_py(), "<u4") if packed else np.asarray(x.as_py()) for x in column if x.is_valid)
            made = [decode(v, next(lists)) if ok else None for ok in column.is_valid().to_pylist()]
            yield pa.RecordBatch.from_arrays([*(t.column(t.schema.names.index(c)) for c in kept), pa.array(made, pa.string())], names=[*kept, text])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.select(*dict.fromkeys([*kept, ids])).mapInArrow(run, f"{fields}, `{text}` string")
