"""Keys, path templates and the names derived from them.

A template is read once on the driver; what reaches the plan is a plain column
expression over the path.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.constants import (
    COUNTRY,
    ENTITY,
    FILE,
    FOLDER,
    LOAD_ID,
    CLUSTER,
    MARKER_ENDINGS,
    MIN_KEY_SLASHES,
    SOURCE_SYSTEM,
    SOURCE_SYSTEM_DB,
)
from quayside.params import LoadParams

_TOKEN = re.compile(r"<[^<>]+>")


def expand(template: str, values: Mapping[str, Column]) -> Column:
    """Template with its tokens replaced by columns, as one concatenation.

    Tokens without a value stay as they are.
    """
    parts: list[Column] = []
    end = 0
    for token in _TOKEN.finditer(template):
        if token.group() in values:
            parts.append(F.lit(template[end : token.start()]))
            parts.append(values[token.group()])
            end = token.end()
    parts.append(F.lit(template[end:]))
    return F.concat(*parts)


def expand_text(template: str, values: Mapping[str, str]) -> str:
    """Template with its tokens replaced by driver-side values."""
    return _TOKEN.sub(lambda token: values.get(token.group(), token.group()), template)


@dataclass(frozen=True)
class EntityRule:
    """Where a source key carries its entity: path segment, and leading
    ``_``-separated parts of that segment that precede the name."""

    segment: int
    skip: int

    @classmethod
    def of(cls, template: str) -> EntityRule:
        before, found, _ = template.partition(ENTITY)
        if not found:
            raise ValueError(f"template has no {ENTITY}: {template}")
        segments = before.split("/")
        return cls(segment=len(segments) - 1, skip=segments[-1].count(">_"))

    def entity(self, path: Column) -> Column:
        """Entity of a key; null where the key is too short for the template."""
        segment = F.get(F.split(path, "/"), F.lit(self.segment))
        return F.get(F.split(segment, "_", self.skip + 1), F.lit(self.skip))

    def folder(self, path: Column) -> Column:
        """The key up to and including the segment that names the entity."""
        return F.substring_index(path, "/", self.segment + 1)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """The path without its last component; a path without ``/`` is kept."""
    name = file_name(path)
    cut = F.left(path, F.length(path) - F.length(name) - F.lit(1))
    return F.when(name == path, path).otherwise(cut)


def segment(path: Column, number: int) -> Column:
    """A path segment by number, from the end if negative; empty if there is none."""
    return F.split_part(path, F.lit("/"), F.lit(number))


def is_data_file(path: Column) -> Column:
    """Not a folder marker."""
    marker = F.lit(False)
    for ending in MARKER_ENDINGS:
        marker = marker | F.endswith(path, F.lit(ending))
    return ~marker


def is_mappable(path: Column, rule: EntityRule) -> Column:
    """The key is long enough to carry an entity and a file name."""
    deep_enough = F.size(F.split(path, "/")) > MIN_KEY_SLASHES
    return deep_enough & rule.entity(path).isNotNull()


def key_under(root: str, file_path: Column) -> Column:
    """Key of a file relative to ``root``, from the URI Spark reports for it.

    ``root`` is a path inside its store. A file that is not below it fails the
    query: a wrong key would be taken for a file of another name.
    """
    anchor = root.rstrip("/") + "/"
    inside = F.regexp_replace(file_path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    raw = F.url_decode(F.replace(inside, F.lit("+"), F.lit("%2B")))
    outside = F.raise_error(F.concat(file_path, F.lit(f" is not below {anchor}")))
    return F.when(F.startswith(raw, F.lit(anchor)), F.substr(raw, F.lit(len(anchor) + 1))).otherwise(outside)


def literal_path(path: str) -> str:
    """``path`` with glob characters escaped, for the reader."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def landing_path(template: str, source_system: str, cluster: str, load_id: str,
                 entity: Column, file: Column) -> Column:
    """Target of one selected file; keeps the case of its parts."""
    fixed = {SOURCE_SYSTEM: source_system, CLUSTER: cluster, LOAD_ID: load_id}
    return expand(expand_text(template, fixed), {ENTITY: entity, FILE: file})


def pull_folder(template: str, params: LoadParams, entity: str) -> str:
    """Folder a pulled entity is written to: cut at the file, lower-cased."""
    return expand_text(
        template.partition(FILE)[0],
        {
            SOURCE_SYSTEM: params.source,
            CLUSTER: params.country,
            ENTITY: entity,
            FOLDER: params.load_id,
        },
    ).lower()


def landed_root(template: str, params: LoadParams) -> str:
    """Folder whose children are the landed entities of this load, lower-cased."""
    values = {COUNTRY: params.country, LOAD_ID: params.load_id}
    return expand_text(template, values).lower()


def database_name(template: str, params: LoadParams) -> str:
    return expand_text(template, {SOURCE_SYSTEM_DB: params.source, COUNTRY: params.country})


def metadata_key(country: Column, entity: Column) -> Column:
    """Key of an entity's metadata row: country and lower-cased entity."""
    return F.concat_ws("_", country, F.lower(entity))


def pull_folder_name(source: Column, country: Column, entity: Column) -> Column:
    """Lower-cased name of the folder that holds the pulls of an entity."""
    return F.lower(F.concat_ws("_", source, country, entity))
