import json
import random
import zlib

import numpy as np
import pytest

from ledgerlift.llm import token_output as to

public = pytest.importorskip("public_tokenizers")
LETTERS = " \n\t\r\x0b\x0c\x1c\x85\xa0　'’.,!?-()<>|endoftextstar_0123456789aAbBeEhHsStTlLvVrRmMéÉẞßİıΣσςĀŁǅ̱́日한ب🙂\x00\x01²ªº×"


@pytest.mark.parametrize("top", [1, 200, 300, 70_000, 1 << 24, 1 << 32])
def test_coding_round_trip(top):
    for n in (0, 1, 4, 1001):
        values = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
        assert (to.decode(*to.encode(values), n) == values).all()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_tokenizer(name, monkeypatch):
    monkeypatch.setattr(to, "REMEMBERED", 500)
    ours = to.Encoder(public.path(name))
    assert ours.by_word == (name == "word_bpe_49k.json")
    picker = random.Random(3)
    texts = ["".join(picker.choice(LETTERS) for _ in range(picker.randrange(40))) for _ in range(1500)] + ["", "<|endoftext|> the <|startoftext|>end", "the cat's hat"]
    want = [x.ids for x in ours.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ours.encode(texts)] == want


def test_files_give_back_every_id(odd, odd_rows, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(to, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(to, "RANGE_BYTES", 4000)
    path = public.path("word_bpe_49k.json")
    to.write_tokens(odd, path, str(tmp_path / "files"))
    got = to.read_tokens(odd.sparkSession, str(tmp_path / "files")).orderBy("start").collect()
    tokenizer = to.Encoder(path).tokenizer
    ids = {(r[0], r[1]): tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in odd_rows}
    assert sorted(map(str, [(r["doc_id"], r["ids"]) for r in got])) == sorted(str((r[0], ids[r[0], r[1]])) for r in odd_rows)
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))
        at += r["n_tokens"]
    assert to.encoded(nothing, path).collect() == []


def test_a_tokenizer_that_replaces_something_else_gets_whole_texts(tmp_path):
    """Steps are compared as a whole: a file whose Replace turns q into z is not encoded word by word."""
    spec = json.loads(open(public.path("word_bpe_49k.json")).read())
    spec["normalizer"]["normalizers"][1] |= {"pattern": {"String": "q"}, "content": "z"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    ours = to.Encoder(str(path))
    assert not ours.by_word
    texts = ["quick queen", "a  quiz"]
    assert [x.tolist() for x in ours.encode(texts)] == [x.ids for x in ours.tokenizer.encode_batch(texts, add_special_tokens=False)]
