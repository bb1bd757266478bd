import hashlib
import io
import random
import zlib

import pytest

from loomline.llm import warc
from loomline.session import fresh_dir

SCHEMA = "page_id long, url string, html string"


def gz(data):
    pack = zlib.compressobj(wbits=31)
    return pack.compress(data) + pack.flush()


def brute(rows):
    """The contract, one page after the other."""
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body]
        top = max(same, key=lambda p: (p is not None, p or 0))
        revisit = len(body) >= 1000 and top != page
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA)
    files = warc.write_warc(pages, fresh_dir(spark, "warc"))
    return warc.read_warc(files), files


def test_contract(spark):
    long, other = "<p>é</p>" * 200, "x" * 999
    rows = [
        (1, "http://a/", long),
        (9, "http://b/\r\nX: y", long),
        (4, None, long),
        (2, "u", other),
        (3, "u", other),
        (5, "", None),
        (6, "u", ""),
        (7, "u", "y" * 1000),
        (8, "u", "y" * 1000),
        (None, "n", "y" * 1000),
    ]
    records, files = round_trip(spark, rows)
    found = sorted((tuple(x) for x in warc.record_digest(records).collect()), key=str)
    assert found == brute(rows)
    assert records.where("gap is not null").count() == 0
    assert sum(x["records"] for x in files.collect()) == len(rows)


def test_repeated_rows_have_one_response(spark):
    rows = [(5, "u1", "z" * 2000)] * 3 + [(4, "u", "z" * 2000)]
    found = [tuple(x) for x in warc.record_digest(round_trip(spark, rows)[0]).collect()]
    assert sorted(x[3] for x in found) == ["response", "revisit", "revisit", "revisit"]
    assert {x[4] for x in found if x[3] == "revisit"} == {5}


def test_copies_without_an_id_have_one_response(spark):
    rows = [(None, f"u{k % 7}", "z" * 2000) for k in range(40)] + [(None, None, "z" * 2000)] * 3 + [(None, "u", "short")] * 2
    found = [tuple(x) for x in warc.record_digest(round_trip(spark, rows)[0]).collect()]
    assert sorted(x[3] for x in found) == ["response"] * 3 + ["revisit"] * 42
    assert all(x[0] is None and x[4] is None for x in found)


def test_clashing_columns(spark):
    rows = [(k, "u", "z" * 2000, "d", "x", 1, 2, "c") for k in (1, 2)]
    names = ", digest string, uri string, top int, n int, copied string"
    files = warc.write_warc(spark.createDataFrame(rows, SCHEMA + names), fresh_dir(spark, "warc"))
    found = warc.record_digest(warc.read_warc(files)).collect()
    assert sorted((x["page_id"], x["record_type"], x["refers_to"]) for x in found) == [(1, "revisit", 2), (2, "response", None)]


def test_empty_table(spark):
    assert round_trip(spark, [])[0].count() == 0


def test_any_gzip_reader_takes_the_archives(spark):
    import gzip

    from loomline.llm.files import resolved

    _, files = round_trip(spark, [(k, "u", f"page {k}") for k in range(5)])
    text = b"".join(gzip.open(resolved(x["path"])[1]).read() for x in files.collect())
    assert text.count(b"WARC/1.1\r\n") == 5


def records(n, seed=0, compress=True):
    rng = random.Random(seed)
    raw = [warc.record(k, f"http://x/{k}", rng.randbytes(rng.randint(0, 3000)), "response", None) for k in range(n)]
    return [gz(x) for x in raw] if compress else raw


def ids(found):
    return [x.headers["warc-record-id"] for x in found if x.headers is not None]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "zero"])
def test_damage_costs_only_what_it_hit(compress, damage):
    parts = records(12, 1, compress)
    hit = 5
    x = bytearray(parts[hit])
    middle = len(x) // 2
    if damage == "flip":
        x[middle] ^= 0xFF
    elif damage == "cut":
        del x[middle:]
    elif damage == "insert":
        x[0:0] = b"garbage \x1f\x8b\x08 more WARC/1.0\r\nnonsense"
    else:
        x[middle : middle + 20] = bytes(len(x[middle : middle + 20]))
    data = b"".join([*parts[:hit], bytes(x), *parts[hit + 1 :]])
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    want = [f"<urn:page:{k}>" for k in range(12) if k != hit or damage == "insert"]
    assert ids(found) == want
    gaps = [x for x in found if x.headers is None]
    assert gaps and all(x.reason for x in gaps)
    covered = sum(x.length for x in found)
    assert covered == len(data)  # records and gaps are the whole file


def test_damage_at_both_ends_and_whole_files():
    parts = records(4, 2)
    data = b"junk" + b"".join(parts) + parts[0][:50]
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    assert ids(found) == [f"<urn:page:{k}>" for k in range(4)]
    assert [(x.offset, x.length) for x in found if x.headers is None] == [(0, 4), (len(data) - 50, 50)]
    assert [x.length for x in warc.salvage(io.BytesIO(b"nothing at all"), 14)] == [14]
    assert list(warc.salvage(io.BytesIO(b""), 0)) == []


def test_a_wrong_digest_is_a_gap():
    raw = warc.record(1, "u", b"body text", "response", None).replace(b"body text", b"body tixt")
    data = gz(raw) + records(2, 3)[1]
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    assert "digest" in found[0].reason and ids(found) == ["<urn:page:1>"]


def test_mixed_archives_and_members_of_several_records():
    raw = records(6, 4, False)
    data = gz(raw[0] + raw[1]) + raw[2] + raw[3] + gz(raw[4]) + raw[5]
    assert ids(warc.salvage(io.BytesIO(data), len(data))) == [f"<urn:page:{k}>" for k in range(6)]


def test_large_record_spans_chunks():
    body = random.Random(5).randbytes(3 * warc.CHUNK)
    data = gz(warc.record(1, "u", body, "response", None)) + gz(warc.record(2, "u", b"", "response", None))
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    assert found[0].payload == body and ids(found) == ["<urn:page:1>", "<urn:page:2>"]


def held_ids(data):
    return [int(x.split(":")[2][:-1]) for x in ids(warc.salvage(io.BytesIO(data), len(data)))]


@pytest.mark.parametrize("held", [warc.HELD, 1000])
def test_a_bad_record_within_a_member_costs_only_itself(monkeypatch, held):
    monkeypatch.setattr(warc, "HELD", held)
    monkeypatch.setattr(warc, "CHUNK", 1 << 12)
    raw = records(40, 6, False)
    for wrong in (raw[7].replace(b"HTTP/1.1", b"HTTP/1.2"), raw[7][:200], raw[7].replace(b"Content-Length: ", b"Content-Length: 9"), raw[7][10:], b"WARC/1.1\r\n"):
        data = gz(b"".join([*raw[:7], wrong, *raw[8:]])) + gz(raw[7])
        found = list(warc.salvage(io.BytesIO(data), len(data)))
        assert held_ids(data) == [*range(7), *range(8, 40), 7]
        assert len([x for x in found if x.headers is None]) == 1


@pytest.mark.parametrize("held", [warc.HELD, 1000])
@pytest.mark.parametrize("damage", ["flip", "cut", "checksum"])
def test_records_ahead_of_damage_in_a_member_stay(monkeypatch, held, damage):
    monkeypatch.setattr(warc, "HELD", held)
    raw = records(40, 7, False)
    whole = bytearray(gz(b"".join(raw)))
    at = len(whole) * 3 // 4
    if damage == "flip":
        whole[at : at + 40] = bytes(40)
    elif damage == "cut":
        del whole[at:]
    else:
        whole[-6] ^= 0xFF
    sizes = [0]
    for x in raw:
        sizes.append(sizes[-1] + len(x))
    reached = len(zlib.decompressobj(wbits=31).decompress(bytes(whole[: at if damage != "checksum" else -8])))
    before = max(k for k in range(41) if sizes[k] <= reached)
    data = bytes(whole) + gz(raw[0]) + gz(raw[1])
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    assert before >= 28 and held_ids(data) == [*range(before), 0, 1]
    gaps = [x for x in found if x.headers is None]
    assert len(gaps) == 1 and gaps[0].offset + gaps[0].length == len(whole)
    assert gaps[0].length <= len(whole) - at + 3100 if damage != "checksum" else gaps[0].length < 100


def test_without_a_digest_a_damaged_member_proves_nothing():
    bare = b"WARC/1.1\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n"
    whole = gz(bare * 3)
    assert len([x for x in warc.salvage(io.BytesIO(whole), len(whole)) if x.headers is not None]) == 3
    data = whole[:-6] + b"zz" + whole[-4:]
    assert [x.headers for x in warc.salvage(io.BytesIO(data), len(data))] == [None]


@pytest.mark.parametrize("compress", [True, False])
def test_headers_of_any_length_are_read(compress):
    long = "data:text/html," + "x" * 1_000_000
    raw = [warc.record(k, long if k == 1 else "u" * 65_000 * k, b"body", "response", None) for k in range(4)]
    data = b"".join(gz(x) if compress else x for x in raw)
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    assert ids(found) == [f"<urn:page:{k}>" for k in range(4)] and found[1].headers["warc-target-uri"] == long


def test_a_page_with_a_long_url_stays_and_a_lost_one_fails(spark):
    rows = [(1, "data:," + "y" * 200_000, "a"), (2, "u", "b")]
    records, files = round_trip(spark, rows)
    found = warc.record_digest(records)
    assert sorted(x["page_id"] for x in found.collect()) == [1, 2]
    warc.all_read(files, found)
    with pytest.raises(ValueError, match="2 records were written and 1 read"):
        warc.all_read(files, found.where("page_id = 1"))
