"""URL column functions (URL-1 resolve_url, CAT-1 subject_of).

Pure expressions: regex splits plus a fold over path segments.  Spark's
``parse_url`` throws on a space in the path (shipped image URLs have them),
so the split is done with the RFC 3986 appendix-B pattern instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardforge.functions._col import as_col, let

# scheme, "//authority", path, "?query", "#fragment"
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*):"
_SPLIT = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"

# plain URLs: scheme and host, and with the folders of a path without empty segments
_ORIGIN = r"^https?://[^/?#]+"
_FOLDER = _ORIGIN + r"/(?:[^/?#]+/)*+(?=[^/?#]*(?:[?#]|\z))"
# plain references: whole URLs, paths from the root, names (with folders) beside the page
_WHOLE = r"^https?://[^/?#][^?#]*\z"
_FROM_ROOT = r"^/(?!/)[^?#]*\z"
_BESIDE = r"^(?:[a-zA-Z0-9_%~-][^/?#:]*/)*+[a-zA-Z0-9_%~-][^/?#:]*\z"


def _part(c: Column, idx: int) -> Column:
    """Regex group as a nullable string (empty group -> null)."""
    v = F.regexp_extract(c, _SPLIT, idx)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def _remove_dots(segments: Column) -> Column:
    """Resolve '.' and '..' over an array of path segments (a '..' at the
    root is dropped); a final '.' or '..' leaves a trailing slash."""
    def fold(segs):
        stack = F.aggregate(
            segs, F.array().cast("array<string>"),
            lambda acc, seg: F.when(seg == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1))
                                    .otherwise(acc))
            .when(seg == ".", acc)
            .otherwise(F.array_append(acc, seg)))
        trailing = F.try_element_at(segs, F.lit(-1)).isin(".", "..")
        return let(stack, lambda st: F.array_join(F.when(trailing, F.array_append(st, F.lit(""))).otherwise(st), "/"))
    return let(let(segments, fold), lambda j: F.when(j == "", F.lit("/")).otherwise(j))


def _split(c: Column) -> Column:
    """struct(scheme, auth, path, query, frag); absent parts null, path ''."""
    return F.struct(_part(c, 1).alias("scheme"), _part(c, 2).alias("auth"),
                    F.regexp_extract(c, _SPLIT, 3).alias("path"), _part(c, 4).alias("query"),
                    _part(c, 5).alias("frag"))


def resolve_url(base, href) -> Column:
    """``urllib.parse.urljoin(base, href)`` for hierarchical (http-like) URLs.

    * empty href -> base; null href -> null
    * href with its own scheme and authority (or another scheme) -> href
    * ``//host/p`` -> base scheme + href
    * ``?q`` / ``#f`` / ``;p`` -> base path kept
    * ``/p`` and relative paths -> dot segments removed; in a relative merge
      empty middle segments are dropped, as urljoin does

    Plain references (no query, fragment or dot segments but one leading ``../``) to plain
    bases are concatenated; for all others each URL is split once (``let``) and the
    parts are reused.
    """
    b, h = as_col(base), as_col(href)
    origin, folder = F.regexp_extract(b, _ORIGIN, 0), F.regexp_extract(b, _FOLDER, 0)
    up = F.when(folder.rlike(_ORIGIN + "/$"), folder).otherwise(F.regexp_replace(folder, "[^/]+/$", ""))
    rest = F.substr(h, F.lit(4))
    return (F.when((origin != "") & h.rlike(_WHOLE), h)
            .when((origin != "") & h.rlike(_FROM_ROOT) & ~F.contains(h, F.lit("/.")), F.concat(origin, h))
            .when((folder != "") & ~F.contains(folder, F.lit("/.")) & h.rlike(_BESIDE), F.concat(folder, h))
            .when((folder != "") & ~F.contains(folder, F.lit("/.")) & h.startswith("../") & rest.rlike(_BESIDE), F.concat(up, rest))
            .otherwise(_resolve(b, h)))


def _resolve(b: Column, h: Column) -> Column:
    """``resolve_url`` of any two URLs."""
    return let(_split(b), lambda bp: let(_split(h), lambda hp: _join(b, h, bp, hp)))


def _join(b: Column, h: Column, bp: Column, hp: Column) -> Column:
    b_scheme, b_auth, b_path, b_query = bp["scheme"], bp["auth"], bp["path"], bp["query"]
    h_scheme, h_path, h_query, h_frag = hp["scheme"], hp["path"], hp["query"], hp["frag"]
    # an empty authority ("//" then a path, query or nothing) keeps the base host
    h_auth = F.when(hp["auth"] != "//", hp["auth"])
    same_scheme = F.lower(h_scheme) == F.lower(F.coalesce(b_scheme, F.lit("")))
    absolute = h_scheme.isNotNull() & (~same_scheme | h_auth.isNotNull())
    scheme_prefix = F.coalesce(F.concat(F.lower(b_scheme), F.lit(":")), F.lit(""))
    prefix = F.concat(scheme_prefix, F.coalesce(b_auth, F.lit("")))

    # urljoin drops an empty "?" and "#": only non-empty parts are re-added
    def tail(query, frag):
        return F.concat(F.coalesce(F.when(query != "?", query), F.lit("")),
                        F.coalesce(F.when(frag != "#", frag), F.lit("")))

    def merged_path(base_dir):
        # relative merge: base directory + href segments, empty middles dropped
        merged = F.concat(base_dir, F.split(h_path, "/"))
        return let(merged, lambda m: F.when(F.size(m) <= 2, m).otherwise(F.concat(
            F.slice(m, 1, 1), F.filter(F.slice(m, 2, F.size(m) - 2), lambda x: x != ""), F.slice(m, -1, 1))))

    def base_dir(segs):
        d = F.when(F.try_element_at(segs, F.lit(-1)) != "", F.slice(segs, 1, F.size(segs) - 1)).otherwise(segs)
        return F.when(F.size(d) == 0, F.array(F.lit(""))).otherwise(d)

    path = F.when(h_path.startswith("/"), _remove_dots(F.split(h_path, "/"))) \
        .otherwise(_remove_dots(merged_path(base_dir(F.split(b_path, "/")))))
    path = let(path, lambda p: F.when(b_auth.isNotNull() & ~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p))

    only_suffix = F.concat(prefix, b_path, tail(F.coalesce(F.when(h_query != "?", h_query), b_query), h_frag))
    joined = F.concat(prefix, path, tail(h_query, h_frag))
    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when(b.isNull() | (b == ""), h)
            .when(h == "", b)
            # same scheme with its own host: re-serialized (empty "?" / "#" dropped)
            .when(absolute & same_scheme, F.concat(F.lower(h_scheme), F.lit(":"), h_auth, h_path,
                                                   tail(h_query, h_frag)))
            .when(absolute, h)
            .when(h_auth.isNotNull(), F.concat(scheme_prefix, h_auth, h_path, tail(h_query, h_frag)))
            .when(h_path == "", only_suffix)
            .otherwise(joined))


# The schemes whose last path segment ``urlparse`` splits
# ``;params`` from (urllib.parse.uses_params).
USES_PARAMS = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip",
               "sips", "mms", "sftp", "tel")


def url_path(url) -> Column:
    """Path component as ``urlparse`` gives it (params of the last segment
    split off for the schemes that have them)."""
    u = as_col(url)
    path = F.regexp_extract(u, _SPLIT, 3)
    scheme = F.lower(F.regexp_extract(u, _SPLIT, 1))
    return F.when(scheme.isin(*USES_PARAMS), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)


def subject_of(url) -> Column:
    """CAT-1: first non-empty path segment, else ``'unknown'``; host, query
    and fragment ignored (``urlparse(u).path.strip('/').split('/')[0]``)."""
    trimmed = F.regexp_replace(url_path(url), r"^/+|/+$", "")
    first = F.substring_index(trimmed, "/", 1)
    return F.when(as_col(url).isNull() | (first == ""), F.lit("unknown")).otherwise(first)
