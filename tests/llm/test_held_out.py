"""The personal-data field on sentences that it wasn't trained on, order of packing, and files that claim too much."""

import collections
import struct

import pyarrow.parquet as pq
import pytest

pytest.importorskip("tandemlake.llm")

from tandemlake.llm import media, packing, pii  # noqa: E402

# Invented sentences; the marked words are personal data. None of them stands in the field's table.
HELD_OUT = [
    "please forward it to {email maria [at] garden [dot] org} tonight",
    "my address is {email paul(at)river(dot)example} for now",
    "questions go to {email help at museum dot org} only",
    "you may write {email n.olsen [at] harbour.example.net} about tickets",
    "bills are sent from {email billing (at) market.example} each month",
    "contact: {email otto at mill dot co dot example}",
    "Anna uses {email anna_k [at] books [dot] example [dot] org} since May",
    "reply to {email editor{at}paper{dot}example} within a week",
    "letters for {email desk <at> tower.example} arrive late",
    "their mailbox {email info[at]school[dot]example} is full",
    "the router {ip 2001:db8:85a3::8a2e:370:7334} restarted",
    "packets from {ip fe80::d4a8:6435:d2d8:d9f3} were lost",
    "blocked {ip 2001:db8:0:1:1:1:1:1} after midnight",
    "new host {ip fd12:3456:789a:1::1} joined",
    "traffic to {ip 2001:db8::1:0:0:1} doubled",
    "ping {ip 2001:0db8:1234:5678:9abc:def0:1234:5678} failed",
    "gateway {ip fe80::21b:77ff:fbd6:7860} answers",
    "my number is {phone (030) 555-0187} at work",
    "text me at {phone 646-555-0142} later",
    "office {phone 312.555.0119} is closed",
    "the hotline {phone 0800 555 0101} is free",
    "phone {phone 020 7946 0123} or come by",
    "call her on {phone (617) 555-0166} tomorrow",
    "fax number {phone 503-555-0128} works again",
    "reach us under {phone 0044 20 7946 0321} daily",
    "mobile {phone 0171 5550134} please",
    "tel. {phone 07700 900123} evenings",
    "his cell is {phone 702.555.0173} now",
    "they paid with {card 3782 822463 10005} abroad",
    "card no {card 6011 0009 9013 9424} is blocked",
    "visa {card 4222222222222} was refused",
    "the meeting is at noon and the dot matrix printer waits",
    "dot by dot the picture grew while they met at school",
    "look at this dot com bubble in the history book",
    "version 2.4.1 came on 2023-11-30 at 09:15:27",
    "pages 120-135, 140-155 and 160-175 are missing",
    "he won 6-4 3-6 7-5 in three sets",
    "isbn 0-306-40615-2 and issn 2049-3630",
    "time 12:34:56:78 on the tape",
    "ratio 4:3:2:1 of sand, lime, gravel and water",
    "part 555-12 and lot 1234 5678",
    "between 1999 2000 2001 2002 prices fell",
    "order 20231130123456 is late",
    "coordinates 52.5200 13.4050 near the river",
    "price 1.234.567 in 2019",
    "mac 00:1b:44:11:3a:b7 of the printer",
    "c++ std::vector and std::map are used",
    "token 9233A8ECF7C5B09FE5949719B6B82BC439E9329B was revoked",
    "population 1 234 567 in the year 1990",
    "the code (212) means blue and (555) means red",
    "room 101-110, floor 3, wing 12",
    "flight 123 at gate 45 leaves 10-12",
    # a second set, written after the training table was last changed
    "the editor is {email greta [at] journal [dot] example} until June",
    "complaints: {email office(at)railway(dot)example}",
    "{email luis at bakery dot net} bakes on Sundays",
    "ask the choir at {email choir (at) chapel.example.org} first",
    "{email j_moor[at]lab.example} keeps the samples",
    "send proofs to {email print at press dot example} please",
    "peer {ip 2001:db8:cafe::17} left the mesh",
    "log shows {ip fe80::a00:27ff:fe4e:66a1} again and again",
    "range begins at {ip 2001:db8:5:6:7:8:9:a} today",
    "ring {phone (0221) 555-0143} before noon",
    "her line is {phone 0160 5550177} now",
    "desk {phone 718.555.0150} or {phone 718-555-0151}",
    "call {phone 0041 44 555 01 23} for directions",
    "the ferry leaves at dusk dot on the horizon",
    "tracks 12-1 14-2 and 16-3 of disc 4",
    "the score stood at 3:2:1 after hours",
    "std::chrono::seconds is a type",
    "order 77 123 456 was shipped in 2020",
]


def spans(line):
    text, out, at = "", [], 0
    for m in [*pii._MARK.finditer(line), None]:
        text += line[at : m.start() if m else len(line)]
        if m:
            out.append((m.group(1), len(text), len(text) + len(m.group(2))))
            text += m.group(2)
            at = m.end()
    return text, out


@pytest.fixture(scope="module")
def field():
    return pii.Field(*pii.train())


def test_field_on_held_out_sentences(field):
    """Recall and precision of spans that no base pattern finds; by kind and over all."""
    assert not set(HELD_OUT) & set(pii.LABELLED)
    right, wanted, given = collections.Counter(), collections.Counter(), collections.Counter()
    for line in HELD_OUT:
        text, want = spans(line)
        ((base, found),) = pii.find([text], field)
        want = [s for s in want if s not in base]
        more = [s for s in found if s not in base]
        wanted.update(k for k, _, _ in want)
        given.update(k for k, _, _ in more)
        right.update(k for k, a, b in more if (k, a, b) in want)
    assert sum(right.values()) >= 0.9 * sum(wanted.values()) and sum(right.values()) >= 0.9 * sum(given.values())
    assert all(right[k] >= least * wanted[k] for k, least in (("email", 0.75), ("ip", 0.9), ("phone", 0.9))), (right, wanted)


def test_field_leaves_clean_documents_alone(field):
    """Documents without digits and without any word for at or dot have no spans."""
    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist() if t and not any(c.isdigit() for c in t) and "@" not in t]
    assert len(texts) > 20 and all(not every for _, every in pii.find(texts, field))


def test_many_spans_in_one_text(field):
    """Overlap is told in one pass over both lists; each base span stays, and nothing is added twice."""
    text = " ".join(["call +1 (555) 123-4567 or", "ask bob [at] example [dot] com about", "10.0.0.1"] * 300)
    ((base, every),) = pii.find([text], field)
    assert set(base) <= set(every) and len(every) - len(base) == 300 and len(set(every)) == len(every)
    added = [s for s in every if s not in base]
    assert not any(a < y and x < b for _, a, b in added for _, x, y in base)


def test_packing_of_repeated_ids_does_not_follow_partitions(spark):
    """Rows of one doc_id, and of none, with different texts lie in one order however the table is cut."""
    rows = [(i if i % 3 else 7, f"text number {i} " * (1 + i % 5), "a" if i % 2 else None) for i in range(60)] + [(None, f"no id {i}", "a") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    results = [sorted(map(tuple, packing.pack_documents(d, weights=(3.0, 1.0), with_ids=False).collect()), key=repr) for d in (docs.repartition(1), docs.repartition(5), docs.orderBy("text"))]
    assert results[0] == results[1] == results[2]


def gif(width, height, images=b""):
    return b"GIF89a" + struct.pack("<HHBBB", width, height, 0, 0, 0) + images + b"\x3b"


def test_files_that_claim_too_much(spark):
    """A screen or an image of 65535 x 65535 counts as damaged, whatever its bytes; others in the batch are read."""
    image = b"\x2c" + struct.pack("<HHHHB", 0, 0, 65535, 65535, 0) + b"\x08\x02\x00\x01\x00"
    good = media.store_gif([media.pad(b"good " * 200)])[0]
    files = [gif(65535, 65535), gif(10, 10, image), good, None, gif(3, 2)]
    assert [f is None for f in media.decode_gifs(files)] == [True, True, False, True, False]
    out = media.media_columns(spark.createDataFrame([(i, 1, f) for i, f in enumerate(files)], "doc_id long, n_bytes long, media binary")).toPandas().set_index("doc_id")
    assert out["payload_bytes"].isna().tolist() == [True, True, False, True, False] and out["media_bytes"].isna().tolist() == [False, False, False, True, False]


def test_large_files_are_decoded_in_parts(monkeypatch):
    """The same frames, histograms and damage whether a file fits into what is decoded at once or not."""
    files = [media.store_gif([media.pad(bytes([i]) * 5000)])[0] for i in (65, 66)]
    cut = files[0][:-9] + b"\x00\x3b"
    whole = [None if f is None else [(x.start_ms, x.indices.tobytes(), x.canvas.tobytes()) for x in f] for f in media.decode_gifs([*files, cut])]
    monkeypatch.setattr(media, "DECODED_PIXELS", 700)
    parts = [None if f is None else [(x.start_ms, x.indices.tobytes(), x.canvas.tobytes()) for x in f] for f in media.decode_gifs([*files, cut])]
    assert parts == whole and len(whole[0]) > 3
