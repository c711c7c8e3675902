import collections
import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mergeweave.llm import align
from mergeweave.llm.queries import op12_alignment, tokenizer_path

from .helpers import ODD, ODD_IDS, docs, prose

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [k for k in range(256) if k not in own]
    to_byte = {chr(k): k for k in own} | {chr(256 + i): k for i, k in enumerate(rest)}
    return a, b, to_byte


def tokens(plain, text):
    a, b, to_byte = plain
    if not text:
        return [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for i in ids_b:
        p = b.id_to_piece(i)
        bytes_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], []
    return list(zip(ids_a, bytes_a, strict=True)), list(zip(ids_b, bytes_b, strict=True))


def groups(a, b):
    out, i, j = [], 0, 0
    while i < len(a):
        left, right, x, y = [], [], 0, 0
        while not left or x != y:
            if x <= y:
                left.append(a[i][0])
                x += len(a[i][1])
                i += 1
            else:
                right.append(b[j][0])
                y += len(b[j][1])
                j += 1
        out.append((left, right))
    return out


def brute(plain, rows):
    made = []
    for i, text in rows:
        a, b = tokens(plain, text)
        made.append((i, len(a), len(b), groups(a, b)))
    count = collections.Counter(p for _, _, _, g in made for p in {(x, y) for left, right in g for x in left for y in right})
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for i, n_a, n_b, g in made:
        links = [(x, y) for left, right in g for x in left for y in right]
        said = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        out.append((i, n_a, n_b, len(g), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
shown = lambda df: sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)

HARD = [*ODD, "<|endoftext|> <s> </s> <unk> <0x41>", "▁x", "a▁b", "  two  spaces ", " lead", "trail ", "tab\there\r\nline;\r\n", "12345678901234567890" * 40, "aaaa" * 3000, "中文字 ภาษา", "\U0001f468‍\U0001f469‍\U0001f467 é", "x" * 200_000, "it's don't I'LL", "()[]{};\r", "\xa0  　", "a|b,c;d"]
HARD_IDS = [*ODD_IDS, *range(100, 100 + len(HARD) - len(ODD))]


@pytest.mark.parametrize("bound", [None, 0])
def test_as_by_definition(spark, plain, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(align, "BROADCAST_GROUPS", bound)
    assert shown(align.report(docs(spark, HARD, HARD_IDS), A, B)) == brute(plain, list(zip(HARD_IDS, HARD, strict=True)))


ALPHABET = st.sampled_from(list("ab '1.\n\té ́\U0001f600|<>中▁") + ["  ", "'s", "ing", "\r\n", "<|endoftext|>", "<s>", "\x1c", "\x85", "tion", " the"])


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET, max_size=14).map("".join))
def test_parts_encode_as_the_whole(text):
    t = align.tokenizers_of(A, B)
    assert t.encode([text, text, ""]) == [t.whole(text) if text else None] * 2 + [None]


def test_groups_of_many_parts_at_once(plain):
    parts, made = ["the", "x" * 300, "12345", "don't", "中文字", "unbelievably;odd", "\nline"], {}
    align.tokenizers_of(A, B)._learn(parts, made)
    assert list(made) == parts
    for p in parts[:-1]:
        a, b = tokens(plain, p)
        said = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups(a, b))
        assert made[p] == (said, len(a), len(b))


def test_no_more_parts_are_kept_than_there_is_room_for():
    t = align.Tokenizers(A, B, 50)
    texts = [prose(30, k) for k in range(20)]
    assert [t.encode([x])[0] for x in texts] == [t.whole(x) for x in texts] and len(t.known) <= 50


def test_given_table(spark, data, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(op12_alignment(spark, data)) == brute(plain, rows)


def test_repeats_and_empty_table(spark, plain):
    texts = [prose(200, 3)] * 300 + [prose(50, k) for k in range(40)]
    ids = [1] * 100 + [None] * 100 + [*range(140)]
    assert shown(align.report(docs(spark, texts, ids), A, B)) == brute(plain, list(zip(ids, texts, strict=True)))
    assert align.report(docs(spark, ["x"]).limit(0), A, B).count() == 0


def test_different_groups_beside_all(spark):
    texts = [*HARD, prose(300, 5), f"{prose(60, 6)} unbelievably;odd unbelievably;odd"]
    seen = 0
    for r in align.aligned(docs(spark, texts, range(len(texts))), A, B).collect():
        single, several = ([g for g in r[c].split(";") if g] for c in ("single", "several"))
        assert sorted(single + several) == sorted({*r["groups"].split(";")} - {""})
        assert not any("," in g for g in single) and all("," in g for g in several)
        seen += bool(single) and bool(several) and len(single) + len(several) < r["n_groups"]
    assert seen > 1


def test_counting_pairs_reads_no_groups_of_a_text_for_each_pair(spark, plain):
    texts = [*HARD, prose(300, 5), f"{prose(60, 6)} unbelievably;odd"]
    made = align.aligned(docs(spark, texts, range(len(texts))), A, B)
    counted = align.counts(made)
    above = counted._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")
    assert len(above) == 2 and "single" not in above[0] and "split(" in above[1]
    found = [groups(*tokens(plain, t)) for t in texts]
    n = collections.Counter(p for g in found for p in {f"{x}|{y}" for left, right in g for x in left for y in right})
    alone = {f"{left[0]}|{right[0]}" for g in found for left, right in g if len(left) == len(right) == 1}
    rows = {r["pair"]: (r["a"], r["n"], r["alone"]) for r in counted.collect()}
    assert rows == {p: (int(p.split("|")[0]), k, p in alone) for p, k in n.items()} and len(alone) < len(n)
