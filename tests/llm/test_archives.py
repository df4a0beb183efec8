"""WARC archives, secrets, and the pipeline."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from tierlake.llm import secret_scans, warc
from tierlake.llm.work import work_folder

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def secrets_by_hand(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def test_spans_equal_by_hand(odd):
    rows, docs = odd
    want = Counter()
    for i, text in rows:
        spans = secrets_by_hand(text)
        counts = [spans.count(k + ":") for k in ("assign", "access", "hex")]
        want[(i, *counts, hashlib.sha256(spans.encode()).hexdigest(), spans)] += 1
    assert Counter(tuple(r)[:6] for r in secret_scans.scan(docs).collect()) == want
    assert sum("assign" in k[5] for k in want) == 2


def test_ledger_scans_only_what_is_new(spark, documents):
    path = work_folder(spark, "ledger")
    first = documents([(1, "token=abcdefghijklmnop"), (2, "plain"), (3, "plain"), (4, None)])
    assert secret_scans.scan(first, path).count() == 4
    assert spark.read.parquet(path).count() == 3
    more = documents([(9, "plain"), (10, "deadbeefdeadbeef0")])
    found = {r.doc_id: r.spans for r in secret_scans.scan(more, path).collect()}
    assert found == {9: "", 10: "hex:0:17"}
    assert spark.read.parquet(path).count() == 4
    assert secret_scans.scan_blobs(more, spark.read.parquet(path)).count() == 0
    assert secret_scans.scan_blobs(more, spark.read.parquet(path), version="2").count() == 2
    assert secret_scans.scan(documents([])).count() == 0


def test_redaction(documents):
    docs = documents([
        (1, 'é token = "abcdefghijklmnop", then deadbeefdeadbeef0.'), (2, "nothing"), (3, None),
        (4, "secret=deadbeefdeadbeef0zz"),
    ])
    out = secret_scans.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    clean = 'é token = "[SECRET]", then [SECRET].'
    assert got == {1: (clean, len(clean)), 2: ("nothing", 7), 3: (None, None), 4: ("secret=[SECRET]", 15)}


def test_written_archives_read_back(spark):
    big = "x" * (1 << 24) + "end"
    rows = [
        (1, "http://a/1", "é" * 60), (2, "http://a/2?q=ü x", "é" * 60), (3, None, "short"), (4, "u", "short"),
        (5, "u\r\nEvil: 1", None), (6, "u", ""), (None, "u", "é" * 60), (2, "again", "é" * 60), (1, "twice", "é" * 60),
        (8, "u", big), (9, "u", "WARC/1.0\r\n\r\n\x1f\x8b\x08" * 40), (10, "u", big),
    ]
    pages = spark.createDataFrame([(*r, "x", b"y") for r in rows], "page_id long, url string, html string, digest string, member binary")
    path = work_folder(spark, "warc")
    warc.write_archives(pages, path)
    read = warc.read_archives(spark, path).collect()
    want = Counter()
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        target = min(same) if len(payload) >= 100 and page != min(same) else None
        want[page, "response" if target is None else "revisit", target, len(payload), hashlib.sha256(payload).hexdigest()] += 1
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read) == want
    assert not [r for r in read if r.gap]
    assert {r.page_id: bytes(r.payload) for r in read if r.page_id in (8, 9)} == {8: big.encode(), 9: rows[10][2].encode()}
    empty = work_folder(spark, "warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def records(n):
    out = []
    for i in range(n):
        payload = f"payload {i} ".encode() * 20
        out.append(warc.record(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), None, "1970-01-01T00:00:00Z"))
    return out


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    plain = records(6)
    parts = [warc.member(r) for r in plain] if packed else plain
    assert gzip.decompress(b"".join(parts)) == b"".join(plain) if packed else True
    hurt = [bytearray(p) for p in parts]
    hurt[1][-40] ^= 0x55
    hurt[3] = hurt[3][: len(hurt[3]) // 2]
    junk = b"\x1f\x8b\x08junk WARC/1.0\r\nnot a record"
    data = bytes(hurt[0] + hurt[1] + hurt[2] + hurt[3] + hurt[4]) + junk + bytes(hurt[5])
    found = list(warc.salvage(data))
    ids = [f[2]["warc-record-id"] for f in found if f[2]]
    assert ids == [f"<urn:page:{i}>" for i in (0, 2, 4, 5)]
    gaps = [(f[0], f[1]) for f in found if f[4]]
    at = [len(b"".join(map(bytes, hurt[:i]))) for i in range(6)]
    assert gaps == [(at[1], at[2]), (at[3], at[4]), (at[5], at[5] + len(junk))]
    # Every byte is in a record or in a gap.
    place = 0
    for start, end, *_ in found:
        assert start == place
        place = end
    assert place == len(data)


def packed_whole(parts, level=6):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"".join(parts)) + packer.flush()


def page_ids(found):
    return [int(f[2]["warc-record-id"][10:-1]) for f in found if f[2]]


def test_salvage_inside_a_member():
    plain = records(6)
    plain[1] = plain[1].replace(b"Content-Length", b"Content-Len")  # header
    plain[3] = plain[3].replace(b"payload 3", b"Payload 3", 1)  # digest
    plain[5] = plain[5][:-4]  # end
    whole = packed_whole(plain)
    data = whole + warc.member(records(8)[7])
    found = list(warc.salvage(data))
    assert page_ids(found) == [0, 2, 4, 7]
    assert all(f[:2] == (0, len(whole)) and f[6] is None for f in found[:-1])
    at = [len(b"".join(plain[:i])) for i in range(7)]
    assert [f[5] for f in found[:-1]] == list(zip(at, at[1:]))
    assert [f[5] for f in found if f[4]] == [(at[i], at[i + 1]) for i in (1, 3, 5)]


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_before_a_fault_in_a_member(level):
    pick = random.Random(5)
    plain = []
    for i in range(40):
        payload = pick.randbytes(3000)
        plain.append(warc.record(i, "u", payload, hashlib.sha256(payload).hexdigest(), None, "1970-01-01T00:00:00Z"))
    whole, after = packed_whole(plain, level), warc.member(records(100)[99])
    cut = whole[: len(whole) * 3 // 4]
    for data, tail in ((cut, []), (cut + after, [99])):
        found = list(warc.salvage(data))
        ids = page_ids(found)
        assert 28 <= len(ids) - len(tail) <= 30 and ids == [*range(len(ids) - len(tail)), *tail]
        assert {f[6] is None for f in found if f[2] and page_ids([f]) != [99]} == {False}
        gap = [f for f in found if f[4]]
        assert len(gap) == 1 and gap[0][0] == found[0][1] and gap[0][1] == len(cut)
    # A wrong check sum: all its records are there, with the fault beside them.
    hurt = bytearray(whole)
    hurt[-6] ^= 1
    found = list(warc.salvage(bytes(hurt) + after))
    assert page_ids(found) == [*range(40), 99]
    assert [f[4] for f in found if f[4]] == [found[0][6]] and "incorrect data check" in found[0][6]
    assert found[-1][6] is None
    # Broken data in record 20: what was inflated before it in the same piece of input stays.
    hurt = bytearray(whole)
    place = whole.index(plain[20][-1500:-1400]) if level == 0 else len(whole) // 2
    hurt[place : place + 200] = b"\xff" * 200
    ids = page_ids(list(warc.salvage(bytes(hurt) + after)))
    assert ids[:19] == [*range(19)] and ids[-1] == 99 and len(set(ids)) == len(ids)


def test_salvaged_members_as_rows(spark, tmp_path):
    plain = records(5)
    plain[2] = plain[2].replace(b"payload 2", b"Payload 2", 1)
    (tmp_path / "a.warc.gz").write_bytes(packed_whole(plain))
    (tmp_path / "b.warc.gz").write_bytes(packed_whole(records(5))[:-6])
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    kept = [(r.archive[-9], r.page_id, r.member_error) for r in rows if r.gap is None]
    assert sorted(kept) == [("a", i, None) for i in (0, 1, 3, 4)] + [("b", i, "member is cut off") for i in range(5)]
    gaps = sorted((r.archive[-9], r.gap, r.inner_offset, r.inner_length) for r in rows if r.gap)
    assert gaps == [
        ("a", "payload digest differs", len(plain[0] + plain[1]), len(plain[2])), ("b", "member is cut off", None, None),
    ]


def test_salvage_of_nothing_and_of_noise():
    assert list(warc.salvage(b"")) == []
    assert [f[:2] for f in warc.salvage(b"noise" * 10)] == [(0, 50)]
    whole = warc.member(records(1)[0])
    assert [f[4] for f in warc.salvage(whole[:-30])] == ["member is cut off"]


def test_pipeline_against_stages_by_hand(spark):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from .test_pairs import joined_by_hand, leaks_by_hand, shingles
    from .test_rows import rules_by_hand

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r.doc_id for r in corpus_pipeline.rules(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()}
    assert all(not rules_by_hand(t)[5] for i, t in docs if i in kept)
    docs = [(i, t) for i, t in docs if i in kept]
    component = {d: c for d, _, c, _ in joined_by_hand(docs, 5, 80)}
    docs = [(i, t) for i, t in docs if component[i] == i or not shingles(t, 5)]
    bad = {d for d, _ in leaks_by_hand(docs, items)}
    docs = [(i, t) for i, t in docs if i not in bad]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, text in docs:
        spans = sorted((int(s.split(":")[1]), s) for s in filter(None, secrets_by_hand(text).split(",")))
        if not spans:
            want[i] = tokenizer.encode(text, add_special_tokens=False).ids
    got = {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == {i for i, _ in docs}
    assert all(got[i] == ids for i, ids in want.items())
