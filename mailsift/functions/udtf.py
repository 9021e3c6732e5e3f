"""SQL surface (M3): ``mail_parts(raw)`` as a Python UDTF, so SQL users get the MIME walk.

    SELECT m.source_mbox, m.byte_offset, p.*
    FROM mail m, LATERAL mail_parts(m.raw) p

It shares the parse helper of the ``mapInArrow`` stage; the DataFrame jobs use that stage
(Arrow batches), this is the convenience path for SQL.
"""

from __future__ import annotations

import hashlib

from pyspark.sql.functions import udtf


@udtf(returnType="ord INT, content_type STRING, filename STRING, size BIGINT, sha256 STRING",
      useArrow=True)
class MailParts:
    def eval(self, raw):
        from mailsift.operators.parts import parse_mime
        if raw is None:
            return
        parts, _error = parse_mime(bytes(raw))
        for p in parts or []:
            payload = p["payload"]
            yield (p["ord"], p["content_type"], p["filename"],
                   None if payload is None else len(payload),
                   None if payload is None else hashlib.sha256(payload).hexdigest())


def register(spark) -> None:
    spark.udtf.register("mail_parts", MailParts)
