"""URL normalising and the parts of a repository address."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .values import col, let

GITHUB = r"github\.com"
SITE = r"https://github\.com"


def _cut_git(c: Column) -> Column:
    return F.regexp_replace(c, r"\.git$", "")


def normalize_url(url: Column | str) -> Column:
    """Compare key of an address: lower case, no closing slashes, no ``.git``."""
    return _cut_git(F.regexp_replace(F.lower(col(url)), "/+$", ""))


def normalize_repo_url(url: Column | str) -> Column:
    """As ``normalize_url`` and without query and fragment."""
    c = _cut_git(F.regexp_replace(F.trim(col(url)), "/+$", ""))
    return F.lower(F.regexp_replace(c, r"[?#].*$", ""))


def normalize_skip_url(url: Column | str) -> Column:
    """Key of a skip-list address: also drops ``www.`` and reads ``io.github.owner/repo``."""
    c = F.trim(col(url))
    c = F.regexp_replace(c, r"(?i)^io\.github\.([^/]+)/([^/?#]+)$", "https://github.com/$1/$2")
    c = F.regexp_replace(F.lower(c), r"^(https?://)www\.", "$1")
    c = F.regexp_replace(c, r"[?#].*$", "")
    return _cut_git(F.regexp_replace(c, "/+$", ""))


def path_prefixes(url: Column | str) -> Column:
    """Array of the address and every shorter address above it, down to the host.

    A containment test "equal or below" becomes an equi-join on these. What nearly all addresses begin with (the scheme)
    is no address, so it is left out and cannot gather all rows.
    """
    start = F.when(F.get(parts_ := F.split(col(url), "/"), F.lit(1)) == "", 3).otherwise(1)
    return let(F.struct(parts_.alias("p"), start.alias("n")), lambda x: F.when(
        F.size(x["p"]) >= x["n"],
        F.transform(F.sequence(x["n"], F.size(x["p"])), lambda n: F.array_join(F.slice(x["p"], 1, n), "/"))))


def owner_repo(url: Column | str, host: str = GITHUB) -> Column:
    """``owner/repo`` in lower case found anywhere behind ``host``; null if there is none."""
    m = F.regexp_extract(col(url), host + r"/([^/]+)/([^/#?]+)", 0)
    owner = F.lower(F.regexp_extract(col(url), host + r"/([^/]+)/([^/#?]+)", 1))
    repo = F.lower(_cut_git(F.regexp_extract(col(url), host + r"/([^/]+)/([^/#?]+)", 2)))
    return F.when(F.length(m) > 0, F.concat(owner, F.lit("/"), repo))


def repo_slug(url: Column | str, site: str = SITE) -> Column:
    """``owner/repo`` with its case kept, only for addresses that begin with ``site``."""
    m = F.regexp_extract(col(url), rf"^{site}/([^/]+/[^/]+)", 1)
    return F.when(F.length(m) > 0, _cut_git(m))


def split_source_url(url: Column | str, site: str = SITE) -> Column:
    """Struct (owner, repo, ref, sub_path, fragment); ref falls back to HEAD, null for other sites."""
    c = F.regexp_replace(col(url), r"#.*$", "")
    pattern = rf"^{site}/([^/]+)/([^/]+)(?:/(?:tree|blob)/([^/]+)(?:/(.+))?)?"
    part = lambda i: F.regexp_extract(c, pattern, i)
    ref = part(3)
    return F.when(
        F.length(part(1)) > 0,
        F.struct(
            part(1).alias("owner"),
            _cut_git(part(2)).alias("repo"),
            F.when(F.length(ref) > 0, ref).otherwise("HEAD").alias("ref"),
            F.regexp_replace(part(4), "/+$", "").alias("sub_path"),
            F.regexp_extract(col(url), r"#(.*)$", 1).alias("fragment"),
        ),
    )
