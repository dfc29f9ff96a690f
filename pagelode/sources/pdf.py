"""The PDF library and the text tool, where they are at hand."""

from __future__ import annotations

import shutil
import subprocess

try:
    import pymupdf
except ImportError:
    pymupdf = None


def find_tool(explicit: str | None = None, timeout: float = 10.0) -> tuple[str, str] | None:
    """Path and version of pdftotext, or None where it is missing or doesn't answer."""
    path = explicit or shutil.which("pdftotext")
    if path is None:
        return None
    try:
        said = subprocess.run([path, "-v"], capture_output=True, text=True, timeout=timeout)
    except (OSError, subprocess.TimeoutExpired):
        return None
    lines = (said.stderr or said.stdout).splitlines()
    return path, lines[0] if lines else "unknown"
