"""Small hand-written messages with invented people at example.com."""

from __future__ import annotations

from email.message import EmailMessage

RULE = "_" * 32


def message(subject: str, body: str | None, date: str | None = "Mon, 27 Jul 2026 13:45:00 +0000", mid: str | None = None, html: str | None = None) -> EmailMessage:
    m = EmailMessage()
    m["From"] = "Ada Stone <ada@example.com>"
    m["To"] = "Team <team@example.com>"
    m["Subject"] = subject
    if date:
        m["Date"] = date
    if mid:
        m["Message-ID"] = mid
    if body is not None:
        m.set_content(body)
        if html is not None:
            m.add_alternative(html, subtype="html")
    elif html is not None:
        m.set_content(html, subtype="html")
    return m


def direct() -> bytes:
    return message("Pump figures", "Hello,\n\nThe pump figures follow.\n\nAda\n", mid="<direct-1@example.com>").as_bytes()


def forward() -> bytes:
    body = (
        f"\n{RULE}\nFrom: Vic Vendor <vic@example.com>\nSent: Tuesday, July 7, 2026 8:00 AM\n"
        "To: Ada <ada@example.com>;\n Bo <bo@example.com>\nSubject: Re: Quote\n\nCAUTION: EXTERNAL EMAIL\n\nOur quote.\n"
        f"{RULE}\nFrom: Ada <ada@example.com>\nSent: Monday, July 6, 2026 9:00 AM\nTo: Vic <vic@example.com>\n"
        "Subject: Quote\n\nPlease quote.\n"
    )
    return message("Fw: Re: Quote", body, mid="<fwd-1@example.com>").as_bytes()


def html_only() -> bytes:
    return message(
        "Notice", None, mid="<html-1@example.com>",
        html="<html><head><style>p{}</style></head><body><p>Dear <b>team</b>,</p><p>see <a href='http://x.example/a_b'>this</a></p></body></html>",
    ).as_bytes()


def with_attachment() -> bytes:
    m = message("Report", "The report is attached.\n", mid="<att-1@example.com>")
    m.add_attachment(b"Line one of the report\nLine two\n", maintype="text", subtype="plain", filename="report.txt")
    m.add_attachment(b"\x89PNG", maintype="image", subtype="png", filename="logo.png", disposition="inline", cid="<logo>")
    return m.as_bytes()


def no_date() -> bytes:
    return message("Undated", "No date here.\n", date=None, mid="<nodate-1@example.com>").as_bytes()


def other_date() -> bytes:
    return message("Early", "Sent earlier.\n", date="Wed, 15 Jul 2026 10:00:00 +0000", mid="<early-1@example.com>").as_bytes()


def latin() -> bytes:
    return (
        b"From: Zo\xc3\xab <zoe@example.com>\r\nTo: team@example.com\r\nSubject: =?iso-8859-1?Q?Caf=E9?=\r\n"
        b"Date: Mon, 27 Jul 2026 13:45:00 +0000\r\nMessage-ID: <latin-1@example.com>\r\nMIME-Version: 1.0\r\n"
        b"Content-Type: text/plain; charset=iso-8859-1\r\nContent-Transfer-Encoding: quoted-printable\r\n\r\n"
        b"Le caf=E9 est pr=EAt, =\r\nvoil=E0.\r\n"
    )


def nested() -> bytes:
    inner = message("Inner", "Inner text.\n", mid="<inner-1@example.com>")
    m = message("Outer", "Plain part.\n", mid="<nested-1@example.com>", html="<p>Html part.</p>")
    m.add_attachment(inner)
    m.add_attachment(b"x" * 300, maintype="text", subtype="plain", filename="big.txt")
    m.add_attachment(b"PK\x03\x04", maintype="application", subtype="zip", filename="a.zip")
    return m.as_bytes()


def broken() -> bytes:
    return b"From: x@example.com\r\nContent-Type: text/plain; charset=no-such-charset\r\n\r\nbody\r\n"


def mailbox_files() -> dict[str, bytes]:
    return {
        "2026-07-27/direct.eml": direct(),
        "2026-07-27/fwd.EML": forward(),
        "2026-07-27/html.eml": html_only(),
        "2026-07-27/att.eml": with_attachment(),
        "2026-07-27/nodate.eml": no_date(),
        "2026-07-27/early.eml": other_date(),
        "misc/latin.eml": latin(),
        "misc/nested.eml": nested(),
        "misc/copy.eml": direct(),
        "misc/notes.txt": b"not a message",
    }


def write_files(root, files: dict[str, bytes]) -> str:
    import os

    for number, (name, content) in enumerate(files.items()):
        path = root / "emails" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        os.utime(path, (1_750_000_000 + number, 1_750_000_000 + number))
    return str(root)
