"""Shared fixtures: one local Spark session and small hand-made mail messages."""

from __future__ import annotations

import base64
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SEP = "From sender@example.com Mon Jan  5 09:00:00 2026"


@pytest.fixture(scope="session")
def spark():
    from mailsift.session import build_session
    s = build_session("local[4]", 8, app="mailsift-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="mailsift-test-")})
    yield s
    s.stop()


def message(headers: dict, body: str, sep: str = SEP) -> str:
    lines = [sep] + [f"{k}: {v}" for k, v in headers.items()]
    return "\n".join(lines) + "\n\n" + body + "\n"


def plain(mid="p1", subject="Plain", body="Hello there.", date="Mon, 05 Jan 2026 09:00:00 +0000",
          frm="a@example.com", to="b@example.com", extra=None):
    h = {"Message-ID": f"<{mid}@example.com>", "Date": date, "From": frm, "To": to,
         "Subject": subject, "Content-Type": 'text/plain; charset="utf-8"'}
    h.update(extra or {})
    return message(h, body)


def multipart(mid, subtype, parts, subject="Multi", date="Tue, 06 Jan 2026 09:00:00 +0000",
              boundary="B0", frm="a@example.com", to="b@example.com"):
    h = {"Message-ID": f"<{mid}@example.com>", "Date": date, "From": frm, "To": to,
         "Subject": subject, "MIME-Version": "1.0",
         "Content-Type": f'multipart/{subtype}; boundary="{boundary}"'}
    return message(h, container_body(parts, boundary))


def container_body(parts, boundary):
    out = ""
    for p in parts:
        out += f"--{boundary}\n{p}\n"
    return out + f"--{boundary}--"


def leaf(ctype, content, disposition=None, filename=None, b64=False):
    h = [f"Content-Type: {ctype}" + (f'; name="{filename}"' if filename else "")]
    if b64:
        h.append("Content-Transfer-Encoding: base64")
        content = base64.b64encode(content if isinstance(content, bytes) else content.encode()).decode()
    if disposition:
        h.append(f"Content-Disposition: {disposition}" + (f'; filename="{filename}"' if filename else ""))
    return "\n".join(h) + "\n\n" + content


def nested(ctype_sub, parts, boundary):
    return f'Content-Type: multipart/{ctype_sub}; boundary="{boundary}"\n\n' + \
        container_body(parts, boundary)


def mail_frame(spark, raws, sources=None):
    """(source_ord, source_mbox, byte_offset, raw) from message strings."""
    rows = []
    for i, r in enumerate(raws):
        src = (sources or [0] * len(raws))[i]
        rows.append((src, f"arch{src}.mbox", i, r.encode("utf-8") if isinstance(r, str) else r))
    return spark.createDataFrame(rows, "source_ord int, source_mbox string, byte_offset bigint, raw binary")
