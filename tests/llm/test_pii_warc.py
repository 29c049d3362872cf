"""Personal data and WARC fixity against brute force."""

import glob
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from . import brute

pii = pytest.importorskip("demandlake.llm.pii")
from demandlake.llm import queries, warc  # noqa: E402

PARTS = ["a.b", "@", "x-1", ".com", " ", "+4", "9", "1.2.3.4", "255", "256.", "001", "4111 1111 1111 1111", "4111-1111", "-", "(030)", "😀",
         "ü", "\n", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", " iban ", "123-45-6789", "378282246310005", "_", "%", "a@b.c"]


def test_base_spans_match_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(k, "".join(rnd.choices(PARTS, k=rnd.randint(0, 25)))) for k in range(4000)]
    rows += [(5001, None), (5002, ""), (5003, "a@b.c " * 1500), (5004, "1 " * 20_000), (5005, "9" * 100_000), (5006, "a" * 200_000),
             (5007, "+1 " * 30_000), (5008, "1.2.3." * 20_000), (None, "+1 (980) 555-6268"), (5009, "x@y.z"), (5009, "x@y.z")]
    spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, email int, base int").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = brute.pii_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id][:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in ("email:", "ip:", "card:", "phone:")]
        added = r.spans.split(",")[len(want):] if r.spans else []
        assert [s for s in r.spans.split(",") if s][:len(want)] == want
        for span in added:
            kind, start, end = span.split(":")
            part = texts[r.doc_id][int(start):int(end)]
            if kind == "iban":
                plain = part.replace(" ", "")
                assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


@pytest.mark.parametrize("text, want", [
    ("my IBAN is DE89 3704 0044 0532 0130 00.", ["iban"]), ("DE89 3704 0044 0532 0130 01", []), ("GB82WEST12345698765432", ["iban"]),
    ("part 123-45-6789 of", []), ("his SSN: 123-45-6789", ["ssn"]), ("SSN 000-45-6789", []),
    ("order 378282246310005", []), ("amex card 378282246310005", ["short_card"]), ("card 378282246310006", []), ("", []), (None, [])])
def test_added_spans_need_checksums_and_context(spark, text, want):
    row = pii.spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [s.kind for s in row.added] == want and all(s.text == text[s.start:s.end] and s.score >= pii.ACCEPT for s in row.added)


def test_context_reaches_over_other_proposals(spark):
    cases = [
        ("SSN: 123-45-6789, 234-56-7890, 345-67-8901", ["ssn"] * 3),
        ("123-45-6789 234-56-7890 are their ssn", ["ssn"] * 2),
        ("Amex credit card (exp 05/27): 378282246310005", ["short_card"]),
        ("378282246310005 of 01/02/2027 11:12 and 13 is an amex", ["short_card"]),
        ("card 11/22/33/44/55/66/77/88/99/11/22/ 378282246310005", ["short_card"]),
        ("card 11/22/33/44/55/66/77/88/99/11/22/33/44 378282246310005", []),
        ("ssn " + "." * 36 + "123-45-6789", ["ssn"]), ("ssn " + ".," * 20 + " 123-45-6789", [])]
    rows = pii.spans(spark.createDataFrame(list(enumerate(t for t, _ in cases)), "doc_id long, text string")).collect()
    assert {r.doc_id: [s.kind for s in r.added] for r in rows} == {k: want for k, (_, want) in enumerate(cases)}


def test_context_is_cut_from_the_text(spark):
    rnd = random.Random(12)
    parts = [" 123-45-6789", " 378282246310005", " 27", "/", " card", " ssn", " x", ", ", " filler word", " 05/27", "é"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(5, 60))) for _ in range(200)] + ["ssn " + "123-45-6789 " * 300]
    for r in pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        text, got = texts[r.doc_id], {(s.kind, s.start) for s in r.added}
        for kind in pii.ADDED[1:]:
            for m in re.finditer(kind.pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                ok = kind.name == "ssn" or 13 <= len(digits) <= 15 and brute.luhn(digits)
                near = (text[max(m.start() - pii.NEAR, 0):m.start()] + " " + text[m.end():m.end() + pii.NEAR]).lower()
                said = re.search(rf"(?<![a-z])(?:{pii.WORDS[kind.name]})", near)
                covered = any(b.start < m.end() and m.start() < b.end for b in r.base)
                assert ((kind.name, m.start()) in got) == bool(ok and said and not covered), (text[:200], m)


def test_native_plan_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.spans(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.spans(docs.where("false")).collect() == []


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(9)
    rows = [(k, f"http://h{k % 3}.example/{k}", "<p>é\r\n\r\n" + "x" * rnd.randint(0, 400) + "</p>", 1) for k in range(0, 3000, 2)]
    rows += [(None, None, None, 1), (7, None, "", 1), (7, None, "", 1), (9, "u", None, 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, length int")


def test_records_written_are_the_records_laid_out(spark, pages, tmp_path):
    warc.write_warc(pages.where("page_id is not null"), str(tmp_path / "w"))
    read = {(int(r.file.split("file_id=")[1].split("/")[0]), r.position): (r.offset, r.length, r.record_sha256)
            for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    laid = {(r.file_id, r.position): (r.offset, r.length, r.record_sha256) for r in warc.layout(pages.where("page_id is not null")).collect()}
    assert read == laid


def test_damage_on_disk_is_located(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages.where("page_id is not null"), path)
    first = warc.read_warc(spark, path)
    levels = warc.height(first)
    sound = warc.tree(first, levels, "file")
    assert warc.audit(sound, warc.tree(warc.read_warc(spark, path), levels, "file"), levels, "file").collect() == []
    file = sorted(glob.glob(f"{path}/*/*.txt"))[1]
    target = first.where(F.col("file").endswith(os.path.basename(file))).where("position = 137").first()
    with open(file, "r+b") as f:
        f.seek(target.offset + target.length - 6)
        f.write(b"?")
    crc = os.path.join(os.path.dirname(file), "." + os.path.basename(file) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    found = warc.audit(sound, warc.tree(warc.read_warc(spark, path), levels, "file"), levels, "file").collect()
    assert [(os.path.basename(r.file), r.node) for r in found] == [(os.path.basename(file), 137)]


def test_audit_finds_missing_records(spark, pages):
    leaves = warc.layout(pages)
    levels = warc.height(leaves)
    short = leaves.where("not (file_id = 1 and position >= 200)")
    found = warc.audit(warc.tree(leaves, levels), warc.tree(short, levels), levels).collect()
    assert {(r.file_id, r.node) for r in found} == {(r.file_id, r.position) for r in leaves.where("file_id = 1 and position >= 200").collect()}


def test_fixity_of_all_rows(spark, pages):
    rows = warc.fixity(pages).collect()
    assert len(rows) == pages.count()
    html = {r.page_id: r.html for r in pages.collect()}
    assert {r.page_id for r in rows if r.differs} == {r.page_id for r in rows if r.record_sha256.startswith("a7") and html[r.page_id]}
    assert any(r.differs for r in rows)
    broken = {r.file_id for r in rows if r.differs}
    assert all((r.root != r.replica_root) == (r.file_id in broken) for r in rows)
    assert warc.fixity(pages.where("false")).collect() == []
