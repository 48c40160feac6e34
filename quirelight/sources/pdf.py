"""PDF pages and spans as a data source; needs PyMuPDF where it runs. Registered as format("quirelight_pdf")."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGES = "document_id string, page int, raw_text string, width double, height double, rotation int, image_count int, fonts array<string>, error string"
SPANS = "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, font_name string, bold boolean, modality string, page_width double, page_height double, error string"
BOLD = 16
SCALE = 300 / 72  # pixels of recognised pages to points


def page_row(document_id, number, page):
    """A page of PyMuPDF as a row of PAGES."""
    yield document_id, number, page.get_text(), page.rect.width, page.rect.height, page.rotation, len(page.get_images()), [f[3] for f in page.get_fonts()], None


def span_rows(document_id, number, page, recognise=None, first=0):
    """A page's spans as rows of SPANS, numbered from `first`; those of blanks separate words and are kept. A page without
    text is given to recognise(page), if there is one: rows of text, x, y, width, height, of which no weight is known."""
    ord_, width, height = first, page.rect.width, page.rect.height
    for block in page.get_text("dict")["blocks"] if page.get_text().strip() else ():
        for line in block.get("lines", ()):
            for s in line["spans"]:
                if s["text"]:
                    x0, y0, x1, y1 = s["bbox"]
                    yield document_id, number, ord_, s["text"], round(x0, 2), round(y0, 2), round(x1 - x0, 2), round(y1 - y0, 2), round(s["size"], 2), s["font"], bool(s["flags"] & BOLD) or "bold" in s["font"].lower(), "native", width, height, None
                    ord_ += 1
    if ord_ == first and recognise is not None:
        for text, x, y, w, h in recognise(page):
            yield document_id, number, ord_, text, x, y, w, h, h, "OCR", None, "ocr", width, height, None
            ord_ += 1


def recognised_lines(words):
    """Recognised words (block, par, line, text, left, top, width, height in pixels) as lines in points: text, x, y, width,
    height."""
    lines: dict[tuple, list[dict]] = {}
    for w in words:
        if w["text"].strip():
            lines.setdefault((w["block"], w["par"], w["line"]), []).append(w)
    for _, own in sorted(lines.items()):
        own.sort(key=lambda w: w["left"])
        x, y = min(w["left"] for w in own), min(w["top"] for w in own)
        right, foot = max(w["left"] + w["width"] for w in own), max(w["top"] + w["height"] for w in own)
        yield " ".join(w["text"] for w in own), x / SCALE, y / SCALE, (right - x) / SCALE, (foot - y) / SCALE


def recogniser():
    """Lines of a page by Tesseract, or None where it isn't installed."""
    try:
        import pytesseract
        from PIL import Image
    except ImportError:
        return None

    def read(page):
        seen = page.get_pixmap(dpi=300)
        words = pytesseract.image_to_data(Image.frombytes("RGB", (seen.width, seen.height), seen.samples), output_type=pytesseract.Output.DICT)
        names = {"block": "block_num", "par": "par_num", "line": "line_num"} | {n: n for n in ("text", "left", "top", "width", "height")}
        return recognised_lines({n: words[k][i] for n, k in names.items()} for i in range(len(words["text"])))

    return read


def read_content(content: bytes, path: str, spans: bool):
    """Rows of one file; if it fails, those before and one with the error."""
    import hashlib

    try:
        document_id = hashlib.sha256(content).hexdigest()[:16]
        import fitz

        with fitz.open(stream=content, filetype="pdf") as pdf:
            first = 0
            for number, page in enumerate(pdf, 1):
                for row in span_rows(document_id, number, page, recogniser(), first) if spans else page_row(document_id, number, page):
                    first += 1
                    yield row
    except Exception as e:
        yield (None,) * (len((SPANS if spans else PAGES).split(", ")) - 1) + (f"{path}: {e}",)


def read_files(files, spans: bool = False):
    """files: path, content (of pdf_files(), from any store that Spark reads). Their pages, or their spans."""
    import pandas as pd

    schema = SPANS if spans else PAGES
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def read(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):  # one file's rows at a time
                yield pd.DataFrame(list(read_content(bytes(content), path, spans)), columns=names)

    return files.select("path", "content").mapInPandas(read, schema)


class File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class PdfSource(DataSource):
    """Options: path (a folder or file of a store that pyarrow knows, also load()'s argument) or paths (comma-separated),
    table (pages or spans). A file is a partition; one that fails gives one row with the error and the others go on."""

    @classmethod
    def name(cls) -> str:
        return "quirelight_pdf"

    def schema(self) -> str:
        return SPANS if self.options.get("table") == "spans" else PAGES

    def reader(self, schema) -> PdfReader:
        return PdfReader(dict(self.options))


class PdfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files = sorted(x for x in options.get("paths", "").split(",") if x)
        if options.get("path"):
            self.files += listed(options["path"])
        self.spans = options.get("table") == "spans"

    def partitions(self):
        return [File(p) for p in self.files]

    def read(self, partition):
        try:
            fs, at = opened(partition.path)
            with fs.open_input_stream(at) as f:
                content = f.read()
        except OSError as e:
            yield (None,) * (len((SPANS if self.spans else PAGES).split(", ")) - 1) + (f"{partition.path}: {e}",)
            return
        yield from read_content(content, partition.path, self.spans)


def opened(path: str):
    """The file system of a path, and the path in it."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def listed(path: str) -> list[str]:
    """The PDF files of a folder, or the file itself."""
    import pyarrow.fs as pafs

    fs, at = opened(path)
    root = path[: len(path) - len(at)] if path.endswith(at) else ""
    if fs.get_file_info(at).type != pafs.FileType.Directory:
        return [path]
    return sorted(root + x.path for x in fs.get_file_info(pafs.FileSelector(at)) if x.path.lower().endswith(".pdf"))


def ocr_lines(words):
    """Recognised words (document_id, page, block, par, line, text, left, top, width, height in pixels at 300 a inch) as
    spans in points, a span a line."""
    from pyspark.sql import functions as F

    scale = 300 / 72
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("left", "text"))), lambda w: w["text"]), " ")
    lines = words.where(F.trim("text") != "").groupBy("document_id", "page", "block", "par", "line").agg(text.alias("text"), F.min("left").alias("l"), F.min("top").alias("t"), F.max(F.col("left") + F.col("width")).alias("r"), F.max(F.col("top") + F.col("height")).alias("b"))
    size = F.col("b") - F.col("t")
    return lines.select("document_id", "page", "block", "par", "line", "text", (F.col("l") / scale).alias("x"), (F.col("t") / scale).alias("y"), ((F.col("r") - F.col("l")) / scale).alias("width"), (size / scale).alias("height"), (size / scale).alias("font_size"), F.lit("OCR").alias("font_name"), F.lit(None).cast("boolean").alias("bold"), F.lit("ocr").alias("modality"))
