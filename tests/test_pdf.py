"""PDF files made for the reader, a server for downloads, and scripts in place of the scan tools."""

import threading
import zlib
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from lexquarry.sources import pdf, tools

MAP = b"1 beginbfchar\n<01> <0041>\nendbfchar\n1 beginbfrange\n<02> <04> <0062>\n<05> <06> [<00f1> <20ac>]\nendbfrange"


def made(pages, info=b"<< /Title (Caf\xe9 \\(x\\)) /Author <FEFF00D1> >>", packed=True, extra=()):
    kids = b" ".join(b"%d 0 R" % (10 + 2 * i) for i in range(len(pages)))
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + kids + b"] /Count %d /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> >>" % len(pages), 3: b"<< /Type /Font >>", 4: b"<< /Type /Font /ToUnicode 5 0 R >>", 6: info}
    streams = {5: MAP}
    for i, content in enumerate(pages):
        objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * i)
        streams[11 + 2 * i] = content
    out = b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % o for o in objects.items())
    for n, s in streams.items():
        data = zlib.compress(s) if packed else s
        out += b"%d 0 obj\n<< /Length %d %s >>\nstream\n%s\nendstream\nendobj\n" % (n, len(data), b"/Filter /FlateDecode" if packed else b"", data)
    return out + b"".join(extra) + b"trailer << /Root 1 0 R /Info 6 0 R >>\n%%EOF"


@pytest.mark.parametrize("packed", [True, False])
def test_pages_and_information(packed):
    first = b"BT /F1 12 Tf 14 TL 72 700 Td (Section 1. Cover) Tj T* [(ag) -20 (e) -400 (here \\050a\\051)] TJ ET"
    second = b"BT /F2 10 Tf 1 0 0 1 72 600 Tm <0102030405> Tj 0 -12 Td <06> Tj ET"
    info, pages = pdf.read(made([first, second], packed=packed))
    assert info == {"Title": "Café (x)", "Author": "Ñ"}
    assert pages == [("Section 1. Cover\nage here (a)", None), ("Abcdñ\n€", None)]


def test_object_streams_and_damage():
    body = b"1 0 2 34 << /Type /Catalog /Pages 2 0 R >>  << /Kids [10 0 R] >>"
    packed = b"7 0 obj\n<< /Type /ObjStm /N 2 /First 9 /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (len(body), body)
    page = b"10 0 obj\n<< /Type /Page /Contents 11 0 R >>\nendobj\n11 0 obj\n<< /Length 30 >>\nstream\nBT /F1 9 Tf 0 0 Td (x) Tj ET   \nendstream\nendobj\n"
    assert pdf.read(b"%PDF-1.5\n" + packed + page)[1] == [("x", None)]
    bad = b"12 0 obj\n<< /Type /Page /Contents 13 0 R >>\nendobj\n13 0 obj\n<< /Filter /FlateDecode /Length 3 >>\nstream\nabc\nendstream\nendobj\n"
    texts = pdf.read(b"%PDF-1.5\n" + page + bad)[1]
    assert texts[0] == ("x", None) and texts[1][0] == "" and texts[1][1].startswith("page_extraction_failed")
    with pytest.raises(ValueError):
        pdf.read(b"hello")


def test_fallback(monkeypatch):
    monkeypatch.setattr(pdf, "page_text", lambda *a: 1 / 0)
    [(text, warning)] = pdf.read(made([b"BT (one \\051) Tj [(t) 5 (wo)] TJ ET"]))[1]
    assert text == "one )\ntwo" and warning.startswith("fallback_used")


def test_frames(spark, tmp_path):
    (tmp_path / "DO-1-01.pdf").write_bytes(made([b"BT (one) Tj ET", b"BT (two) Tj ET"]))
    (tmp_path / "empty.pdf").write_bytes(made([]))
    (tmp_path / "bad.pdf").write_bytes(b"no pdf")
    pages = pdf.pdf_pages(spark, str(tmp_path))
    rows = {(r.doc_id, r.page_no): (r.raw, r.page_count, r.warning and r.warning.split(":")[0]) for r in pages.collect()}
    assert rows == {("DO-1-01", 1): ("one", 2, None), ("DO-1-01", 2): ("two", 2, None), ("empty", 0): ("", 0, "empty_document"), ("bad", 0): ("", 0, "invalid_pdf")}
    assert {r.doc_id: r.value for r in pdf.pdf_texts(pages).collect()}["DO-1-01"] == "one\ftwo"
    r = pages.where("page_no = 2").first()
    assert r.info["Author"] == "Ñ" and r.file_size == (tmp_path / "DO-1-01.pdf").stat().st_size and len(r.sha256) == 64


def test_download(tmp_path):
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"%PDF-1.4 x" if self.path == "/a.pdf" else b"<html>")

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    try:
        assert tools.download(f"{at}/a.pdf", str(tmp_path / "x/a.pdf")) == 10 and (tmp_path / "x/a.pdf").read_bytes() == b"%PDF-1.4 x"
        with pytest.raises(ValueError):
            tools.download(f"{at}/b", str(tmp_path / "b.pdf"))
        assert not (tmp_path / "b.pdf").exists() and [p.name for p in (tmp_path / "x").iterdir()] == ["a.pdf"]
    finally:
        server.shutdown()


def test_scan_tools(tmp_path):
    render, recognise = tmp_path / "render", tmp_path / "recognise"
    render.write_text('#!/bin/sh\nfor a; do last=$a; done\ntouch "$last-10.png" "$last-02.png"\n')
    recognise.write_text('#!/bin/sh\nbasename "$1"\n')
    for f in (render, recognise):
        f.chmod(0o755)
    target = tmp_path / "t.txt"
    tools.recognised("x.pdf", str(target), render=str(render), recognise=str(recognise))
    assert target.read_text() == "page-02.png\fpage-10.png\n"
    with pytest.raises(FileExistsError):
        tools.recognised("x.pdf", str(target), render=str(render), recognise=str(recognise))
    with pytest.raises(RuntimeError, match="not installed"):
        tools.run_tool([str(tmp_path / "none")])
    with pytest.raises(RuntimeError, match="failed"):
        tools.run_tool(["sh", "-c", "echo bad >&2; exit 3"])
