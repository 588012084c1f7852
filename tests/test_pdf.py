import sys
from types import SimpleNamespace

from callweave.sources.files import pdf_text


def test_pdf_is_read_whole_or_rejected(monkeypatch):
    page = lambda i: SimpleNamespace(extract_text=lambda: f"page {i}\n")
    monkeypatch.setitem(sys.modules, "pypdf", SimpleNamespace(PdfReader=lambda f: SimpleNamespace(pages=[page(i) for i in range(len(f.read()))])))
    assert pdf_text(b"x" * 20) == " ".join(f"page {i}" for i in range(20))
    assert pdf_text(b"x" * 21) is None
