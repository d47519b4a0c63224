"""What lies outside Spark: downloads and the tools that read scanned pages. They run on the driver, file by file."""

from __future__ import annotations

import subprocess
import tempfile
import urllib.request
from pathlib import Path

from lexquarry.sources.files import PDF_MAGIC, write_text

#: How long a download may take, in seconds, and how pages are rendered and read.
TIMEOUT, DPI, LANGUAGE, LAYOUT = 300, 300, "eng", 6


def download(url: str, path: str, timeout: float = TIMEOUT) -> int:
    """Save a PDF file from an address, aside first and then renamed; its size. Anything else than a PDF is an error."""
    target = Path(path)
    part = target.with_name(target.name + ".part")
    with urllib.request.urlopen(url, timeout=timeout) as got:
        data = got.read()
    if not data.startswith(PDF_MAGIC.encode()):
        raise ValueError(f"{url} is no PDF file")
    target.parent.mkdir(parents=True, exist_ok=True)
    part.write_bytes(data)
    part.replace(target)
    return len(data)


def run_tool(command: list[str]) -> str:
    """What a tool prints; an error says which tool failed and why."""
    try:
        done = subprocess.run(command, capture_output=True, text=True, check=False)
    except FileNotFoundError as e:
        raise RuntimeError(f"{command[0]} is not installed") from e
    if done.returncode:
        raise RuntimeError(f"{command[0]} failed: {done.stderr.strip()[:500]}")
    return done.stdout


def scanned_text(pdf: str, first_page: int | None = None, render: str = "pdftoppm", recognise: str = "tesseract") -> str:
    """The text of a scanned file: its pages as grey images, in the order of their names, read one by one; form feeds between them."""
    with tempfile.TemporaryDirectory() as folder:
        run_tool([render, "-r", str(DPI), "-gray", "-png", *(["-f", str(first_page)] if first_page else []), pdf, f"{folder}/page"])
        images = sorted(Path(folder).glob("*.png"))
        return "\f".join(run_tool([recognise, str(i), "stdout", "-l", LANGUAGE, "--psm", str(LAYOUT)]).rstrip("\f\n") for i in images)


def recognised(pdf: str, target: str, replace: bool = False, **tools) -> None:
    """Write the text of a scanned file for review; a reviewed file stays as it is unless ``replace``."""
    write_text(scanned_text(pdf, **tools) + "\n", target, replace)
