"""Paged document scan as a Python Data Source.

``spark.read.format("paged_documents")`` reads a search API that pages by
offset (``startAt``/``maxResults``).  The driver asks the fetcher once for
the total, then plans one input partition per run of pages, so pages are
fetched in parallel by the executors and rows stream into the plan -- the
driver never holds the documents.  The last partition reads on until a page
comes back empty, and every partition steps by the documents it received, so
documents added after the total was read, or short pages, are not lost.

The fetcher is injected: option ``fetcher`` names ``module:factory``;
``factory(options)`` returns an object with

* ``total(query, since) -> int``
* ``page(query, start_at, max_results, since) -> list[dict | str]``
* optionally ``fields() -> list[(id, name)]`` and ``types() -> list[(name, subtask)]``
  for ``resource='fields'`` / ``resource='types'``.

Rows: ``(page bigint, raw string)`` for documents -- one JSON document each.
"""

from __future__ import annotations

import importlib
import json
import math
import urllib.parse
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The API's page size and the per-document expansion asked for.
PAGE_SIZE = 100
SEARCH_FIELDS = "*all"
SEARCH_EXPAND = "changelog"
PAGES_PER_PARTITION = 16


def load_fetcher(options: dict, factory=None):
    """The bound factory if the source was registered with one, else the
    ``module:factory`` named by option ``fetcher`` (must be importable on
    the executors)."""
    if factory is not None and not options.get("fetcher"):
        return factory(options)
    spec = options.get("fetcher")
    if not spec:
        raise ValueError("register the source with a fetcher, or set option 'fetcher' (module:factory)")
    module, _, attr = spec.partition(":")
    return getattr(importlib.import_module(module), attr)(options)


class PagePartition(InputPartition):
    """Pages ``first_page`` to ``last_page``; the last partition is open-ended."""

    def __init__(self, first_page: int, last_page: int, open_end: bool = False):
        super().__init__((first_page, last_page, open_end))
        self.first_page = first_page
        self.last_page = last_page
        self.open_end = open_end


class PagedDocumentsReader(DataSourceReader):
    def __init__(self, options: dict, factory=None):
        self.options = dict(options)
        self.factory = factory
        self.resource = self.options.get("resource", "issues")
        self.page_size = int(self.options.get("page_size", PAGE_SIZE))
        self.per_partition = int(self.options.get("pages_per_partition", PAGES_PER_PARTITION))

    def partitions(self):
        if self.resource != "issues":
            return [PagePartition(0, 0)]
        fetcher = load_fetcher(self.options, self.factory)
        total = int(self.options.get("total") or fetcher.total(self.options.get("query", ""), self.options.get("since")))
        pages = math.ceil(total / self.page_size)
        if pages == 0:
            ranges = [(0, 0)]
        elif hasattr(fetcher, "plan_pages") and "pages_per_partition" not in self.options:
            # the fetcher knows its storage layout (e.g. row groups)
            ranges = fetcher.plan_pages(pages, self.page_size)
        else:
            ranges = [(p, min(p + self.per_partition, pages) - 1) for p in range(0, pages, self.per_partition)]
        # the total is only what was there when it was read: the last range goes on to the end
        return [PagePartition(a, b, k == len(ranges) - 1) for k, (a, b) in enumerate(ranges)]

    def read(self, partition):
        fetcher = load_fetcher(self.options, self.factory)
        if self.resource == "fields":
            for fid, name in fetcher.fields():
                yield (fid, name)
            return
        if self.resource == "types":
            for name, subtask in fetcher.types():
                yield (name, bool(subtask))
            return
        query, since = self.options.get("query", ""), self.options.get("since")
        start, end = partition.first_page * self.page_size, (partition.last_page + 1) * self.page_size
        while partition.open_end or start < end:
            asked = self.page_size if partition.open_end else min(self.page_size, end - start)
            docs = fetcher.page(query, start, asked, since)
            if not docs:  # the page after the last one is empty
                return
            for k, d in enumerate(docs):
                yield ((start + k) // self.page_size, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False))
            start += len(docs)  # a server may return fewer documents than asked for


class PagedDocuments(DataSource):
    fetcher_factory = None

    @classmethod
    def name(cls):
        return "paged_documents"

    def schema(self):
        resource = self.options.get("resource", "issues")
        if resource == "fields":
            return "id string, name string"
        if resource == "types":
            return "name string, subtask boolean"
        return "page bigint, raw string"

    def reader(self, schema):
        return PagedDocumentsReader(self.options, type(self).fetcher_factory)


def register(spark, fetcher=None) -> None:
    """Register ``paged_documents``; ``fetcher`` (a factory taking the
    options) is bound to the source and shipped with it to the executors."""
    if fetcher is None:
        spark.dataSource.register(PagedDocuments)
        return
    bound = type("PagedDocumentsBound", (PagedDocuments,), {"fetcher_factory": staticmethod(fetcher)})
    spark.dataSource.register(bound)


class RestSearchFetcher:
    """Fetcher for a tracker's REST search (bearer token).  Not used in tests:
    no network here.  Options: ``url``, ``token``, ``project``."""

    def __init__(self, options: dict):
        self.url = options["url"].rstrip("/")
        self.token = options.get("token", "")
        self.project = options.get("project")

    def _get(self, path: str, params: dict | None = None):
        q = ("?" + urllib.parse.urlencode(params)) if params else ""
        req = urllib.request.Request(self.url + path + q, headers={"Authorization": f"Bearer {self.token}", "Accept": "application/json"})
        with urllib.request.urlopen(req, timeout=600) as resp:  # noqa: S310
            return json.loads(resp.read().decode("utf-8"))

    def _base(self, query: str) -> str:
        return f"({query})" if query else f"project={self.project}"

    def _jql(self, query: str, since: str | None) -> str:
        return self._base(query) + (f' AND updated > "{since}"' if since else "")

    def _slice(self, query: str, since: str, before: str | None) -> str:
        return self._base(query) + f' AND updated >= "{since}"' + (f' AND updated < "{before}"' if before else "")

    def _total(self, jql: str) -> int:
        return int(self._get("/rest/api/2/search", {"jql": jql, "maxResults": 0})["total"])

    def _issues(self, jql: str, start_at: int, max_results: int) -> list:
        params = {"jql": jql, "startAt": start_at, "maxResults": max_results, "fields": SEARCH_FIELDS, "expand": SEARCH_EXPAND}
        return self._get("/rest/api/2/search", params).get("issues", [])

    # pages by offset: by key, so an update moves no document (new ones come last)

    def total(self, query, since):
        return self._total(self._jql(query, since))

    def page(self, query, start_at, max_results, since):
        return self._issues(self._jql(query, since) + " ORDER BY key ASC", start_at, max_results)

    # by update time (see ``tracker``)

    def now(self) -> str:
        return self._get("/rest/api/2/serverInfo")["serverTime"][:16].replace("-", "/").replace("T", " ")

    def first(self, query) -> str | None:
        found = self._issues(self._base(query) + " ORDER BY updated ASC, key ASC", 0, 1)
        return found[0]["fields"]["updated"][:16].replace("-", "/").replace("T", " ") if found else None

    def count(self, query, since, before) -> int:
        return self._total(self._slice(query, since, before))

    def search(self, query, since, before, start_at, limit) -> list:
        return self._issues(self._slice(query, since, before) + " ORDER BY updated ASC, key ASC", start_at, limit)

    def fields(self):
        return [(f["id"], f["name"]) for f in self._get("/rest/api/2/field")]

    def types(self):
        proj = self._get(f"/rest/api/2/project/{self.project}")
        return [(t["name"], t.get("subtask", False)) for t in proj.get("issueTypes", [])]


def rest_fetcher(options: dict) -> RestSearchFetcher:
    return RestSearchFetcher(options)
