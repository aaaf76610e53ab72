"""Text of PDF files: pages in order, the strings that their content streams show, decoded by the fonts' own maps.

Read are plain and object streams, uncompressed or deflated. Encrypted files, other filters and fonts without a map beyond
Latin give what can be read of them, if need be nothing; a broken file never raises."""

from __future__ import annotations

import re
import zlib

OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
REF = rb"\s*(\d+)\s+\d+\s+R"
TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s/<>\[\]()]+|[\[\]]|[-+]?\d*\.?\d+|[A-Za-z'\"*]+[0-9*]?", re.S)
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b""}
#: A step back of so many thousandths within a line is a blank.
GAP = -180


def literal(token: bytes) -> bytes:
    """The bytes of a string token, (...) or <...>."""
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    return re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)


class Pdf:
    def __init__(self, body: bytes):
        self.objects = {int(m[1]): m[2] for m in OBJECT.finditer(body)}
        self.body = body
        for raw in list(self.objects.values()):
            if re.search(rb"/Type\s*/ObjStm", raw[:400]):
                data, head = self.stream(raw), self.number(raw, b"First")
                pairs = [int(x) for x in data[:head].split()]
                ends = [*pairs[3::2], len(data) - head]
                for no, start, end in zip(pairs[::2], pairs[1::2], ends):
                    self.objects.setdefault(no, data[head + start : head + end])

    def number(self, raw: bytes, key: bytes) -> int:
        m = re.search(rb"/" + key + rb"\s+(\d+)", raw)
        return int(m[1]) if m else 0

    def stream(self, raw: bytes) -> bytes:
        m = STREAM.search(raw)
        if not m:
            return b""
        if b"FlateDecode" not in raw[: m.start()]:
            return m[1]
        try:
            return zlib.decompressobj().decompress(m[1])
        except zlib.error:
            return b""

    def value(self, raw: bytes, key: bytes) -> bytes:
        """What stands under a key, references followed: the text from there on."""
        m = re.search(rb"/" + key + rb"(?![A-Za-z])", raw)
        if not m:
            return b""
        ref = re.match(REF, raw[m.end() :])
        return self.objects.get(int(ref[1]), b"") if ref else raw[m.end() :]

    def pages(self) -> list[tuple[bytes, bytes]]:
        """(page, its resources) in order."""
        root = next((r for r in self.objects.values() if re.search(rb"/Type\s*/Catalog", r)), b"")
        out, todo, seen = [], [(self.value(root, b"Pages"), b"")], set()
        while todo:
            node, resources = todo.pop()
            resources = self.value(node, b"Resources") or resources
            if b"/Kids" in node:
                kids = [int(x) for x in re.findall(REF, self.value(node, b"Kids").split(b"]")[0])]
                todo += [(self.objects.get(k, b""), resources) for k in reversed(kids) if k not in seen]
                seen.update(kids)
            elif node:
                out.append((node, resources))
        return out

    def font_maps(self, resources: bytes) -> dict[bytes, tuple[int, dict[int, str]]]:
        """Font name -> (bytes per code, code -> text)."""
        fonts = self.value(resources, b"Font").split(b">>")[0]
        out = {}
        for name, no in re.findall(rb"/([^\s/<>\[\]()]+)" + REF, fonts):
            raw = self.objects.get(int(no), b"")
            cmap = self.stream(self.value(raw, b"ToUnicode"))
            codes: dict[int, str] = {}
            hexes = lambda x: [literal(t) for t in re.findall(rb"<[0-9A-Fa-f\s]*>", x)]
            for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
                h = hexes(block)
                codes.update((int.from_bytes(a), b.decode("utf-16-be", "replace")) for a, b in zip(h[::2], h[1::2]))
            for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
                for low, high, to in re.findall(rb"(<[^>]*>)\s*(<[^>]*>)\s*(<[^>]*>|\[[^\]]*\])", block):
                    first, last, texts = int.from_bytes(literal(low)), int.from_bytes(literal(high)), hexes(to)
                    for i in range(min(last - first + 1, 65536)):
                        if to[:1] == b"[":
                            codes[first + i] = texts[i].decode("utf-16-be", "replace") if i < len(texts) else ""
                        else:
                            start = texts[0].decode("utf-16-be", "replace")
                            codes[first + i] = start[:-1] + chr(ord(start[-1]) + i) if start else ""
            out[name] = (2 if re.search(rb"/Subtype\s*/Type0", raw) else 1, codes)
        return out

    def text(self, page: bytes, resources: bytes) -> str:
        contents = self.value(page, b"Contents")
        refs = re.findall(REF, contents.split(b"]")[0]) if contents.lstrip()[:1] == b"[" else []
        data = b"\n".join(self.stream(self.objects.get(int(r), b"")) for r in refs) if refs else self.stream(contents)
        fonts, width, codes = self.font_maps(resources), 1, {}
        out: list[str] = []
        stack: list[bytes] = []
        height = None

        def shown(token: bytes) -> str:
            raw = literal(token)
            if width == 1 and not codes:
                return raw.decode("cp1252", "replace")
            return "".join(codes.get(int.from_bytes(raw[i : i + width]), "" if width > 1 else chr(raw[i])) for i in range(0, len(raw), width))

        for m in TOKEN.finditer(data):
            t = m[0]
            if not (t[:1].isalpha() or t in (b"'", b'"')):
                stack.append(t)
                continue
            if t == b"Tf" and len(stack) > 1:
                width, codes = fonts.get(stack[-2][1:], (1, {}))
            elif t in (b"Td", b"TD") and len(stack) > 1:
                out.append("\n" if float(stack[-1]) else " ")
            elif t == b"Tm" and len(stack) > 5:
                out.append("\n" if stack[-1] != height else " ")
                height = stack[-1]
            elif t in (b"T*", b"'", b'"', b"ET"):
                out.append("\n")
            if t in (b"Tj", b"'", b'"', b"TJ"):
                for x in stack:
                    if x[:1] in b"(<":
                        out.append(shown(x))
                    elif t == b"TJ" and x[:1] == b"-" and float(x) < GAP:
                        out.append(" ")
            stack.clear()
        return "".join(out)

    def title(self) -> str:
        m = re.findall(rb"/Info" + REF, self.body)
        raw = self.objects.get(int(m[-1]), b"") if m else b""
        t = re.search(rb"/Title\s*(\(.*?(?<!\\)\)|<[0-9A-Fa-f\s]*>)", raw, re.S)
        data = literal(t[1]) if t else b""
        return (data[2:].decode("utf-16-be", "replace") if data[:2] == b"\xfe\xff" else data.decode("cp1252", "replace")).strip()


def pdf_parts(body: bytes | str | None) -> tuple[str, str]:
    """(title, text) of a PDF; each page with text follows a line with its number. Anything unreadable is empty."""
    data = body.encode("latin-1", "replace") if isinstance(body, str) else bytes(body or b"")
    try:
        pdf = Pdf(data)
        texts = [(i, pdf.text(*page).strip()) for i, page in enumerate(pdf.pages(), 1)]
        return pdf.title(), "\n\n".join(f"--- Page {i} ---\n{t}" for i, t in texts if t)
    except (ValueError, IndexError, OverflowError):
        return "", ""
