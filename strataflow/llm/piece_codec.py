"""SentencePiece encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import packed, text_or_empty

SPACE = "▁"  # fixed by the model format: stands for a blank
SINGLE = -1  # rank of single characters, which are there before any merge
NEVER = 1 << 60
MEMO_WORDS = 400_000  # remembered words of a task; then it starts over
MEMO_CHARS = 64  # of a word that is remembered
MEMO_PAIRS = 2_000_000  # of tokens whose compatibility is remembered


def read_vocabulary(model: bytes) -> dict:
    """What the tasks need of a model, as plain lists: pieces, ids, ranks, and the last merge of each piece.

    Only models are taken whose pieces have the blank at their beginning or are runs of blanks, whose long runs repeat
    the longest such piece, whose normalizer changes nothing but blanks, and whose merges come
    after those of their parts; anything else is refused rather than encoded otherwise.
    """
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    if lib.encode("a  b ﬁ　", out_type=str)[0][0] != SPACE or lib.normalize(" ﬁ　 ") != f"{SPACE}{SPACE}ﬁ　{SPACE}":
        raise ValueError("the model's normalizer is not the one that only marks blanks")
    plain = [i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
    piece = {i: lib.id_to_piece(i) for i in plain}
    runs = {len(p): i for i, p in piece.items() if not p.strip(SPACE)}
    if any(SPACE in p[1:] and p.strip(SPACE) for p in piece.values()):
        raise ValueError("the model has pieces with blanks inside")
    tails, longest = _tails(runs, lib)
    words = sorted((i for i, p in piece.items() if len(p) > 1 and p.strip(SPACE)), key=lambda i: (-lib.get_score(i), i))
    rank = {i: SINGLE for i, p in piece.items() if len(p) == 1} | {i: r for r, i in enumerate(words)}
    by_text = {piece[i]: i for i in rank}
    parts: dict[int, tuple[int, int]] = {}
    for i in words:
        tokens = merge([by_text[c] for c in piece[i] if c in by_text] if all(c in by_text for c in piece[i]) else [], piece, by_text, rank, stop=i)
        if len(tokens) == 2 and piece[tokens[0]] + piece[tokens[1]] == piece[i]:
            if max(rank[tokens[0]], rank[tokens[1]]) >= rank[i]:
                raise ValueError("a merge comes before its parts")
            parts[i] = (tokens[0], tokens[1])
    # Pieces that their own characters never merge into cannot be tokens.
    rank = {i: r for i, r in rank.items() if r == SINGLE or i in parts}
    return {
        "pieces": [(piece[i], i, r, *parts.get(i, (i, i))) for i, r in rank.items()],
        "merges": {piece[i]: r for i, r in rank.items() if r != SINGLE} | {piece[i]: r for r, i in enumerate(words)},
        "tails": tails,
        "longest": (len(tails), runs[longest]),
        "bytes": [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        "begin": lib.bos_id(),
        "end": lib.eos_id(),
    }


def _tails(runs: dict[int, int], lib) -> tuple[list[list[int]], int]:
    """Ids of runs shorter than the longest piece of blanks; longer runs are that piece again and again, then a tail."""
    longest = max(runs)
    piece = {i: SPACE * n for n, i in runs.items()}
    by_text = {p: i for i, p in piece.items()}
    order = sorted({lib.get_score(i) for i in runs.values()}, reverse=True)
    rank = {i: order.index(lib.get_score(i)) for i in runs.values()}
    whole = [merge([runs[1]] * n, piece, by_text, rank) for n in range(4 * longest)]
    tails = whole[:longest]
    if any(ids != [runs[longest]] * (n // longest) + tails[n % longest] for n, ids in enumerate(whole)):
        raise ValueError("the model's runs of blanks do not repeat")
    return tails, longest


def merge(tokens: list[int], piece: dict[int, str], by_text: dict[str, int], rank: dict[int, int], stop: int | None = None) -> list[int]:
    """Merge the best pair again and again, the leftmost of equal ones; halt before the piece ``stop`` is made."""
    while len(tokens) > 1:
        made = [by_text.get(piece[a] + piece[b]) for a, b in zip(tokens, tokens[1:])]
        best = min((rank[m], k) for k, m in enumerate(made) if m is not None) if any(m is not None for m in made) else None
        if best is None or made[best[1]] == stop:
            break
        k = best[1]
        tokens = [*tokens[:k], made[k], *tokens[k + 2 :]]
    return tokens


def word_encoder(vocabulary: dict) -> Callable[[str], list[int]]:
    """Ids of a word with the blank before it (or of what follows a character without a piece)."""
    size_of_ids = 1 + max(i for _, i, *_ in vocabulary["pieces"])
    text, rank, left, right = [""] * size_of_ids, [NEVER] * size_of_ids, [0] * size_of_ids, [0] * size_of_ids
    for p, i, r, a, b in vocabulary["pieces"]:
        text[i], rank[i], left[i], right[i] = p, r, a, b
    merges, spelled = vocabulary["merges"], vocabulary["bytes"]
    single = {p: i for p, i, r, *_ in vocabulary["pieces"] if r == SINGLE}
    automaton = ahocorasick.Automaton()
    for p, i, *_ in vocabulary["pieces"]:
        automaton.add_word(p, (i, len(p)))
    automaton.make_automaton()
    tested: dict[int, bool] = {}  # by a pair as one number, which takes half a tuple's memory; started anew when full

    def compatible(a: int, b: int) -> bool:
        """Whether no merge across the border comes before both sides have merged as they would alone.

        Goes back through the merges of both sides, the later first; at each step the two characters' groups at
        the border may merge if that merge is due before the next one of either side (on equal rank: the left one).
        """
        before_left = before_right = NEVER
        while True:
            due = merges.get(text[a] + text[b])
            if due is not None and due < before_left and due <= before_right:
                return False
            ra, rb = rank[a], rank[b]
            if ra == rb == SINGLE:
                return True
            if ra > rb:
                before_left, a = ra, right[a]
            else:
                before_right, b = rb, left[b]

    def encode(word: str) -> list[int]:
        last = [-1] * len(word)  # the last token of each prefix; every prefix has one
        for end, (token, size) in automaton.iter(word):
            if last[end] >= 0:
                continue
            start = end - size
            if start >= 0:
                before = last[start]
                pair = before * size_of_ids + token
                fits = tested.get(pair)
                if fits is None:
                    if len(tested) >= MEMO_PAIRS:
                        tested.clear()
                    fits = tested[pair] = compatible(before, token)
                if not fits:
                    continue
            last[end] = token
        ids, at = [], len(word) - 1
        while at >= 0:
            ids.append(last[at])
            at -= len(text[last[at]])
        return ids[::-1]

    def encode_any(word: str) -> list[int]:
        ids: list[int] = []
        start = 0
        for i, c in enumerate(word):
            if c not in single:
                if i > start:
                    ids += encode(word[start:i])
                ids += [spelled[b] for b in c.encode("utf-8", "surrogatepass")]
                start = i + 1
        return ids + encode(word[start:]) if start < len(word) else ids

    return encode_any


def text_encoder(vocabulary: dict, memo_words: int = MEMO_WORDS) -> Callable[[str], bytes]:
    """Ids of whole texts, begin and end included, as unsigned 32-bit little-endian numbers."""
    encode_word = word_encoder(vocabulary)
    pack = lambda ids: b"".join(i.to_bytes(4, "little") for i in ids)
    begin, end, packed_blank = pack([vocabulary["begin"]]), pack([vocabulary["end"]]), pack(vocabulary["tails"][1])
    longest, longest_id = vocabulary["longest"]
    tails, full = [pack(ids) for ids in vocabulary["tails"]], pack([longest_id])
    lines: dict[str, bytes] = {}  # what follows a line break
    newline = pack([vocabulary["bytes"][10]])

    def line(text: str) -> bytes:
        found = lines.get(text)
        if found is None and len(text) > MEMO_CHARS:
            return pack(encode_word(text))
        if found is None:
            if len(lines) >= memo_words // 2:
                lines.clear()
            found = lines[text] = pack(encode_word(text))
        return found

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            if len(self) >= memo_words:
                self.clear()
            first, *more = word.split("\n")
            if more:
                found = newline.join([self[first], *map(line, more)])
            else:
                found = pack(encode_word(SPACE + first))
            if len(word) <= MEMO_CHARS:
                self[word] = found
            return found

    words = Words()

    def encode(text: str) -> bytes:
        if not text:
            return begin + end
        parts = text.replace(SPACE, " ").split(" ")
        if "" not in parts:
            return begin + b"".join(map(words.__getitem__, parts)) + end
        out, gap = [begin], 0
        for part in parts:  # an empty part is one more blank before the next word
            if not part:
                gap += 1
                continue
            found = words[part]
            if gap and found.startswith(packed_blank):
                gap, found = gap + 1, found[4:]
            out += [full * (gap // longest), tails[gap % longest], found]
            gap = 0
        return b"".join([*out, full * (gap // longest), tails[gap % longest], end])

    return encode


def _codec(model: bytes, vocabulary: dict, memo_words: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = text_encoder(vocabulary, memo_words)
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            ids = [encode(text) for text in batch]
            yield pd.DataFrame({"ids": ids, "decoded": [lib.decode(memoryview(i).cast("I").tolist()) for i in ids]})

    return run


def encode_and_decode(docs: DataFrame, model: bytes, carry: Sequence[str] = ("doc_id",), text: str = "text", memo_words: int = MEMO_WORDS) -> DataFrame:
    """``doc`` (carried columns), ``ids`` (unsigned 32-bit little-endian, begin and end included) and ``decoded``.

    Words of up to ``MEMO_CHARS`` characters are encoded once per task and remembered, up to a bound in number; each
    stands for itself, since no piece has a blank inside. Longer ones, such as code or base64 without a blank, are
    encoded anew each time, so that what is remembered is bounded in bytes as well. Repeated rows are encoded alike. The model, a file of fixed size, travels with the function. A null text is encoded as an
    empty one, of two ids. Texts of any length are encoded whole. An empty table gives an empty result.
    Input columns travel inside ``doc``.
    """
    codec = F.pandas_udf(_codec(model, read_vocabulary(model), memo_words), "ids binary, decoded string")
    rows = docs.select(packed(carry).alias("doc"), text_or_empty(text).alias("_text"))
    return rows.withColumn("_c", codec("_text")).select("doc", "_c.ids", "_c.decoded")
