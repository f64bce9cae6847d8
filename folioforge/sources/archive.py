"""Manuscript archives: ZIP members, the XML manifest, figures and their source files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import clean_path, figure_label, is_data_member

MEMBERS = "archive string, manuscript_id string, member string, size bigint, manifest string, error string"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each member of each ZIP file below path; the manifest's own row has its text.

    The first XML member is the manifest and its stem the manuscript id; a prefix of that id
    is taken off the members' names. An empty, broken or manifest-less archive gives one row
    with its error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(_members, MEMBERS)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for path, content in zip(b["path"], b["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    infos = z.infolist()
                    xml = next((i.filename for i in infos if i.filename.lower().endswith(".xml")), None)
                    if xml is None:
                        rows.append((path, None, None, None, None, "no manifest" if infos else "empty archive"))
                        continue
                    own = xml.rsplit("/", 1)[-1][:-4]
                    text = z.read(xml).decode("utf-8", "replace")
                    for i in (x for x in infos if not x.is_dir()):
                        rows.append((path, own, i.filename.removeprefix(own + "/"), i.file_size, text if i.filename == xml else None, None))
            except (zipfile.BadZipFile, OSError, RuntimeError) as e:
                rows.append((path, None, None, None, None, f"unreadable: {e}"))
        yield pd.DataFrame(rows, columns=["archive", "manuscript_id", "member", "size", "manifest", "error"])


# Types that a manifest gives its elements.
MANUSCRIPT_TEXT, FIGURE, MERGED_PDF = "Manuscript Text", "Figure", "Merged PDF"
SOURCE_DATA, EXPANDED_VIEW = "Figure Source Data Files", "Expanded View Content (was Supplementary Information)"
# What may stand in for a text document that is missing, the best first.
STAND_INS = (r"^pdf/[^/]+\.pdf$", r"^doc/[^/]+\.tex$", r"^doc/[^/]+\.rtf$", r"^doc/[^/]+\.odt$")


def manuscript_number(xml: Column) -> Column:
    """Text of the article id of type manuscript; empty where there is none."""
    return F.coalesce(F.xpath_string(xml, F.lit("//article-id[@pub-id-type='manuscript']")), F.lit(""))


def elements(manifests: DataFrame, id_col: str, xml: str, *tags: str) -> DataFrame:
    """(id, tag, element_no, object_type, label, object_ids): every element of these names at any
    depth, in the order of the manifest, each with its own label and files; what an element
    lacks is null or empty and shifts nothing. Comments count for nothing. Manifests that are
    no XML give no row."""
    bare = F.regexp_replace(F.col(xml), r"(?s)<!--.*?-->", "")
    names = "|".join(tags)
    parts = F.regexp_extract_all(bare, F.lit(rf"(?s)(<({names})\b[^>]*(?<!/)>.*?</\2>)"), F.lit(1))
    each = manifests.where(F.col(xml).rlike(r"(?s)^\s*<.*>\s*$")).select(id_col, manuscript_number(F.col(xml)).alias("own_id"), F.posexplode(parts).alias("k", "part"))
    text = lambda path: F.nullif(F.trim(F.xpath_string("part", F.lit(path))), F.lit(""))
    files = F.transform(F.filter(F.xpath("part", F.lit("//object_id/text()")), lambda p: F.trim(p) != ""), lambda p: F.trim(p))
    return each.select(
        id_col, "own_id", F.regexp_extract("part", r"^<(\w[\w-]*)", 1).alias("tag"), (F.col("k") + 1).alias("element_no"),
        F.nullif(F.xpath_string("part", F.lit("/*/@object-type")), F.lit("")).alias("object_type"), text("/*/label").alias("label"), files.alias("object_ids"),
    )


def _first_file() -> Column:
    return clean_path(F.get("object_ids", F.lit(0)), F.col("own_id"))


def figures(manifests: DataFrame, id_col: str, xml: str) -> DataFrame:
    """(id, figure_no, label, image): figures of a manifest but the expanded-view ones, labels in
    one form, paths without the manuscript's id. A figure without a label has a null one."""
    each = elements(manifests, id_col, xml, "fig").where(F.col("object_type") == FIGURE)
    kept = each.where(F.coalesce(~F.col("label").contains("EV"), F.lit(True)))
    return kept.select(id_col, F.col("element_no").alias("figure_no"), figure_label(F.col("label")).alias("label"), _first_file().alias("image"))


def source_files(manifests: DataFrame, id_col: str, xml: str) -> DataFrame:
    """(id, label, path) of all files of the forms of source data."""
    each = elements(manifests, id_col, xml, "form").where(F.col("object_type") == SOURCE_DATA)
    return each.select(id_col, "label", "own_id", F.explode("object_ids").alias("path")).select(id_col, "label", clean_path(F.col("path"), F.col("own_id")).alias("path"))


def merged_pdf(manifests: DataFrame, id_col: str, xml: str) -> DataFrame:
    """(id, pdf): the first merged PDF that a manifest names."""
    each = elements(manifests, id_col, xml, "merged_pdf").where(F.col("object_type") == MERGED_PDF)
    return each.groupBy(id_col).agg(F.min_by(_first_file(), "element_no").alias("pdf"))


def appendix(manifests: DataFrame, id_col: str, xml: str) -> DataFrame:
    """(id, element_no, path) of the appendix files."""
    each = elements(manifests, id_col, xml, "form").where((F.col("object_type") == EXPANDED_VIEW) & (F.col("label") == "Appendix"))
    return each.select(id_col, "element_no", _first_file().alias("path"))


def text_document(manifests: DataFrame, members: DataFrame, id_col: str, xml: str) -> DataFrame:
    """(id, path, kind): the document of each manuscript: the first DOCX that the manifest names
    and the archive holds, else a PDF, LaTeX, RTF or ODT file of the archive, the first by name;
    null with kind "none" where there is none. members: (id, member), names without the id."""
    named = elements(manifests, id_col, xml, "doc", "supplementary-material").where(F.col("object_type") == MANUSCRIPT_TEXT)
    docx = named.select(id_col, F.struct(F.lit(0).alias("kind"), F.col("element_no").alias("place"), F.lit("").alias("name")).alias("rank"), _first_file().alias("path")).where(F.lower("path").endswith(".docx"))
    here = docx.join(members.select(id_col, F.col("member").alias("path")).distinct(), [id_col, "path"], "left_semi").select(id_col, "rank", "path")
    kind = F.coalesce(*[F.when(F.col("member").rlike(p), k) for k, p in enumerate(STAND_INS, 1)])
    other = members.select(id_col, F.struct(kind.alias("kind"), F.lit(0).alias("place"), F.col("member").alias("name")).alias("rank"), F.col("member").alias("path")).where("rank.kind IS NOT NULL")
    best = here.unionByName(other).groupBy(id_col).agg(F.min_by(F.struct("rank.kind", "path"), "rank").alias("b"))
    names = F.element_at(F.array(*[F.lit(x) for x in ("docx", "pdf", "tex", "rtf", "odt")]), F.col("b.kind") + 1)
    return manifests.select(id_col).join(best, id_col, "left").select(id_col, F.col("b.path").alias("path"), F.when(F.col("b").isNull(), "none").otherwise(names).alias("kind"))


def structures(manifests: DataFrame, members: DataFrame, id_col: str, xml: str) -> DataFrame:
    """One row for each manifest: its number, document, merged PDF, appendix and figures with their
    source files, in order; error says what no manuscript can lack."""
    figs = figures(manifests, id_col, xml)
    sources = attach_sources(figs, source_files(manifests, id_col, xml), id_col, exact=False).groupBy(id_col, "label").agg(F.array_sort(F.collect_set("path")).alias("sd_files"))
    listed = figs.join(sources, [id_col, "label"], "left").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("figure_no", "label", "image", F.coalesce("sd_files", F.array().cast("array<string>")).alias("sd_files")))).alias("figures"))
    extra = appendix(manifests, id_col, xml).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("element_no", "path"))).alias("a"))
    whole = manifests.select(id_col, manuscript_number(F.col(xml)).alias("manuscript_id")).join(text_document(manifests, members, id_col, xml), id_col)
    for part in (merged_pdf(manifests, id_col, xml), extra, listed):
        whole = whole.join(part, id_col, "left")
    error = F.when(F.col("path").isNull() & F.col("pdf").isNull(), "no manuscript file")
    return whole.select(id_col, "manuscript_id", F.col("path").alias("document"), "kind", "pdf", F.coalesce("a.path", F.array().cast("array<string>")).alias("appendix"), "figures", error.alias("error"))


def attach_sources(figs: DataFrame, files: DataFrame, id_col: str, exact: bool = True) -> DataFrame:
    """(id, figure label, path): files whose label names the figure, once each.

    exact compares numbers; otherwise Figure 1 also takes the files of Figure 10, as a plain
    search for the name in the label does. The numbers in a file's label are joined on equality,
    without exact each with all its beginnings.
    """
    a = figs.select(id_col, "label", F.regexp_extract("label", r"([0-9]+)", 1).alias("n")).where("n <> ''")
    numbers = F.regexp_extract_all(F.translate("label", " ", ""), F.lit("Fig(?:ure)?([0-9]+)"), F.lit(1))
    b = files.select(id_col, "path", F.explode(F.array_distinct(numbers)).alias("n"))
    if not exact:
        b = b.select(id_col, "path", F.explode(F.transform(F.sequence(F.lit(1), F.length("n")), lambda k: F.col("n").substr(F.lit(1), k))).alias("n"))
    return a.join(b, [id_col, "n"]).select(id_col, "label", "path").distinct()


def data_members(members: DataFrame) -> DataFrame:
    return members.where(is_data_member(F.col("member")))
