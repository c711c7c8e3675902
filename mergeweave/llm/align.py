"""Alignment of two tokenizers over the same texts.

Python tokenises, by a byte-level BPE (A) and a piece BPE with byte fallback (B).
Byte offsets at which a token of both ends cut the tokens into groups. Where a text
can be cut, so that both tokenizers encode its parts apart, each part ends at such
an offset, and the groups of a text are those of its parts in order; so they are
made once for a part that is kept. The different groups of a text go beside them, those
of a token each apart, because these are links themselves. Tokens of a group are linked, each of A's with
each of B's. All counting is Spark's: documents with a linked pair of ids by one
aggregation; what that makes of each different group goes back to the documents.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import slices, stored, texts_of
from .tokens import _ODD, _ODD_WIDE

#: Up to so many different groups (two hashes and three numbers each) go to all tasks; beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 1_000_000
#: Different parts of texts whose groups a worker keeps.
CACHE = 250_000


#: Groups as ``a1,a2|b1;a3|b2``, and the numbers of tokens of A and B.
Groups = tuple[str, int, int]


class _Known(dict):
    """Groups of parts that are kept, and beside them those of one call alone."""

    beside: dict[str, Groups | None]

    def __missing__(self, part: str) -> Groups | None:
        return self.beside[part]


class Tokenizers:
    """A over space and text, B over the text, which puts the space there itself.

    Neither has a token that goes on after a space between two characters that
    are not white space, or over a single line feed; there a text without other
    white space is cut, and what each part becomes is kept. Other texts are
    encoded whole. Results are those of encoding whole texts (tests compare them).
    """

    def __init__(self, a_path: str, b_path: str, cache: int = CACHE):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are what runs side by side
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(own)]
        byte_of = {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(others)}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(byte_of[c] for c in self.a.id_to_token(i)) if all(c in byte_of for c in self.a.id_to_token(i)) else b"" for i in range(size)]
        n = self.b.get_piece_size()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        # a token and what follows it: in its group, and at its end; those of B after those of A
        said = [f"{i}{mark}" for count, marks in ((size, ",|"), (n, ",;")) for i in range(count) for mark in marks]
        self.said, self.lengths = np.array(said, dtype=object), np.array([len(x) for x in said], dtype=np.int64)
        self.cuts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") or "\n" in self.b.id_to_piece(i) for i in range(n))
        self.known = _Known()
        self.room = cache

    def _groups(self, a: list[int], b: list[int], n_a: list[int], n_b: list[int]) -> Iterator[Groups]:
        """Groups of several parts at once, that have so many of the tokens each, and the same bytes by both tokenizers."""
        a_ids, b_ids = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        a_last, b_last = np.isin(a_ends, b_ends), np.isin(b_ends, a_ends)
        a_stops, b_stops = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        # a group's tokens of A come after those of B of all groups before, those of B after those of A up to its own
        a_at = np.arange(len(a_ids)) + np.repeat(np.concatenate([[0], b_stops[:-1]]), np.diff(a_stops, prepend=0))
        b_at = np.arange(len(b_ids)) + np.repeat(a_stops, np.diff(b_stops, prepend=0))
        which = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        which[a_at], which[b_at] = 2 * a_ids + a_last, 2 * (len(self.a_sizes) + b_ids) + b_last
        every = "".join(self.said[which].tolist())
        stops = np.cumsum(self.lengths[which])[np.cumsum(np.add(n_a, n_b)) - 1].tolist()
        return zip([every[x : y - 1] for x, y in zip([0, *stops], stops, strict=False)], n_a, n_b, strict=True)

    def whole(self, text: str) -> Groups | None:
        """Groups of a text encoded whole; None where the bytes of either tokenizer aren't those of the text."""
        try:
            want = f" {text}".encode()
        except UnicodeEncodeError:
            return None
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        if b"".join([self.a_bytes[i] for i in a]) != want or b"".join([self.b_bytes[i] for i in b]) != want:
            return None
        return next(self._groups(a, b, [len(a)], [len(b)]))

    def _learn(self, parts: list[str], into: dict[str, Groups | None]) -> None:
        """Groups of parts, by one call of each library; None for parts that either doesn't tell whole."""
        said = [p if p[:1] == "\n" else f" {p}" for p in parts]
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        encodings = self.a.encode_batch_fast(said, add_special_tokens=False)
        told, every_a, every_b, n_a, n_b = [], [], [], [], []
        for part, text, encoding, b in zip(parts, said, encodings, self.b.encode(parts, num_threads=1), strict=True):
            # B puts a space before what it is given, which is a token of its own before a line feed
            a, b, want = encoding.ids, b if text[0] == " " else b[1:], text.encode()
            if b"".join(map(a_bytes, a)) == want and b"".join(map(b_bytes, b)) == want:
                told.append(part)
                every_a += a
                every_b += b
                n_a.append(len(a))
                n_b.append(len(b))
            else:
                into[part] = None
        if told:
            into.update(zip(told, self._groups(every_a, every_b, n_a, n_b), strict=True))

    def _parts(self, text: str) -> list[str] | None:
        """Where the text can be cut, else None."""
        if not self.cuts or text[0] in " \n" or text[-1] in " \n" or any(c in text for c in _ODD) or not text.isascii() and any(c in text for c in _ODD_WIDE):
            return None
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> list[Groups | None]:
        """As ``whole`` for each text; None for an empty text too."""
        cut = [self._parts(t) if t else None for t in texts]
        known, here = self.known, {}
        try:
            self._learn(list(set().union(*filter(None, cut)).difference(known)), here)
        except UnicodeEncodeError:
            return [self.whole(t) if t else None for t in texts]
        if len(known) + len(here) <= self.room:
            known.update(here)
            here = {}
        known.beside, get, out = here, known.__getitem__, []
        for text, parts in zip(texts, cut, strict=True):
            if not text:
                out.append(None)
                continue
            found = list(map(get, parts)) if parts else [None]
            if None in found:
                out.append(self.whole(text))
            else:
                said, a, b = zip(*found, strict=True)
                out.append((";".join(said), sum(a), sum(b)))
        return out


_PAIRS: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    """One for each worker process."""
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = Tokenizers(a_path, b_path)
    return _PAIRS[a_path, b_path]


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, groups, single, several)`` of every row of ``docs``.

    groups: ``a1,a2|b1;a3|b2``, in order, empty for texts that have no tokens.
    single, several: the different ones of a token of each, and of more, in any order.
    """

    def run(batches):
        t = tokenizers_of(a_path, b_path)
        for batch in batches:
            for piece in slices(batch, "text", 2_000_000):
                found = [x or ("", 0, 0) for x in t.encode(texts_of(piece.column(1)))]
                said, a, b = zip(*found, strict=True)
                n, single, several = [g.count("|") for g in said], [], []
                for groups in said:
                    different = set(groups.split(";"))
                    more = [g for g in different if "," in g]
                    single.append(";".join(different.difference(more)))
                    several.append(";".join(more))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array(x, pa.int64()) for x in (a, b, n)), *(pa.array(x, pa.string()) for x in (said, single, several))],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups", "single", "several"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups string, single string, several string")


def each_group(groups: Column) -> Column:
    return F.when(groups == "", F.array().cast("array<string>")).otherwise(F.split(groups, ";"))


def links_of(group: Column) -> Column:
    """The links of a group, ``a|b`` each, repeats included."""
    ids = lambda k: F.split(F.split_part(group, F.lit("|"), F.lit(k)), ",")
    every = F.flatten(F.transform(ids(1), lambda a: F.transform(ids(2), lambda b: F.concat(a, F.lit("|"), b))))
    return F.when(F.contains(group, F.lit(",")), every).otherwise(F.array(group))


def _key(group: Column) -> list[Column]:
    return [F.xxhash64(group).alias("h1"), F.xxhash64(F.lit(7), group).alias("h2")]


def counts(made: DataFrame) -> DataFrame:
    """``(pair, a, n, alone)`` of each different id pair that is linked in ``made(n_groups, single, several, ...)``; see ``alignment``."""
    pairs = F.array_union(each_group(F.col("single")), F.flatten(F.transform(each_group(F.col("several")), links_of)))
    # those of a token each come first; how many, in a step before: beside posexplode, Spark would find it anew for each pair
    rows = made.where("n_groups > 0").select("single", "several", F.size(each_group(F.col("single"))).alias("first"))
    every = rows.select("first", F.posexplode(pairs).alias("at", "pair"))
    counted = every.groupBy("pair").agg(F.count("*").alias("n"), F.max(F.col("at") < F.col("first")).alias("alone"))
    return counted.select("pair", F.split_part("pair", F.lit("|"), F.lit(1)).cast("int").alias("a"), "n", "alone")


def alignment(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """Two tables: a stored one of all rows ``(row, doc_id, n_a, n_b, n_groups, groups, single, several)``, and of each different id pair that is linked ``(pair, a, n, alone)``: in how many documents, and whether it is a group itself in any."""
    rows = aligned(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id())
    made = stored(rows, "aligned", compression="zstd")
    return made, stored(counts(made), "pairs")


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row of ``docs(doc_id, text, ...)``.

    Texts that are null, empty or not told whole by the bytes of both tokenizers
    have no tokens: zeros, and an empty string for the hash. Every row is a
    document, one that repeats or has no doc_id too. Texts are taken whole,
    however long; other columns are ignored, whatever their names. An empty
    table gives an empty result. n_best counts links whose pair is the most
    frequent of its A id, ties included; count_sum adds up the counts of the links' pairs.
    """
    made, counted = alignment(docs, a_path, b_path)
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    valued = counted.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    several = made.where("several != ''").select(F.explode(each_group(F.col("several"))).alias("group")).distinct()
    different = counted.where("alone").select(F.col("pair").alias("group")).union(several)
    links = different.select(*_key(F.col("group")), F.explode(links_of(F.col("group"))).alias("pair"))
    worth = stored(links.join(valued, "pair").groupBy("h1", "h2").agg(F.count("*").alias("links"), F.sum("best").alias("best"), F.sum("n").alias("counts")), "groups")
    small = worth.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    each = made.where("n_groups > 0").select("row", F.explode(each_group(F.col("groups"))).alias("group")).select("row", *_key(F.col("group")))
    if small:
        found = each.join(F.broadcast(worth), ["h1", "h2"]).groupBy("row").agg(F.sum("links").alias("n_links"), F.sum("best").alias("n_best"), F.sum("counts").alias("count_sum"))
    else:  # a document's repeated groups go as one
        times = each.groupBy("row", "h1", "h2").agg(F.count("*").alias("times"))
        product = lambda c: F.sum(F.col(c) * F.col("times"))
        found = times.join(worth, ["h1", "h2"]).groupBy("row").agg(product("links").alias("n_links"), product("best").alias("n_best"), product("counts").alias("count_sum"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    plain = made.select("row", "doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return plain.join(found, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
