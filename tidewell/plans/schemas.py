"""Tables of the collection store: columns, unique keys and what a merge does on conflict."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    keys: list[list[str]] = field(default_factory=list)
    policy: str = "fail"
    #: A column that the store numbers, and columns whose least and greatest value it keeps for each folder.
    serial: str | None = None
    zones: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


# The tables' columns, keys and policies.
_TABLES = [
    Table("_migrations", "version int, name string, applied_at timestamp", [["version"]]),
    Table("_runs", "id long, source string, started_at timestamp, finished_at timestamp, status string, records long, errors long, duplicates long, requests long, bytes long", [["id"]]),
    Table("_source_state", "source string, state string, updated_at timestamp", [["source"]], "replace"),
    Table("_errors", "run_id long, source string, occurred_at timestamp, error string, context string"),
    Table("test_records", "seq long, payload string, hash string, run_id long, collected_at timestamp", [["seq"]], "ignore", zones=("seq",)),
    Table("rss_feeds", "url string, title string, link string, description string, language string, last_status int, last_fetched_at timestamp, item_count long, updated_at timestamp", [["url"]], "replace"),
    Table("rss_items", "feed string, guid string, url string, title string, author string, summary string, content string, categories string, published_at timestamp, updated_at timestamp, collected_at timestamp, run_id long", [["feed", "guid"]], "ignore"),
    Table(
        "gdelt_events",
        "global_event_id long, day long, month_year long, year long, fraction_date double, actor1_code string, actor1_name string, actor1_country string, actor1_known_group string, actor1_type1 string, "
        "actor2_code string, actor2_name string, actor2_country string, actor2_known_group string, actor2_type1 string, is_root_event long, event_code string, event_base_code string, event_root_code string, "
        "quad_class long, goldstein_scale double, num_mentions long, num_sources long, num_articles long, avg_tone double, actor1_geo_country string, actor1_geo_lat double, actor1_geo_long double, "
        "actor2_geo_country string, actor2_geo_lat double, actor2_geo_long double, action_geo_type long, action_geo_fullname string, action_geo_country string, action_geo_adm1 string, action_geo_lat double, "
        "action_geo_long double, action_geo_feature_id string, date_added long, date_added_at timestamp, source_url string, source_file string, collected_at timestamp, run_id long",
        [["global_event_id"]],
        "ignore",
    ),
    Table(
        "gdelt_mentions",
        "global_event_id long, event_time_date long, mention_time_date long, mention_time_at timestamp, mention_type long, mention_source_name string, mention_identifier string, sentence_id long, in_raw_text long, "
        "confidence long, mention_doc_len long, mention_doc_tone double, source_file string, collected_at timestamp, run_id long",
        [["global_event_id", "mention_identifier", "sentence_id"]],
        "ignore",
    ),
    Table("gdelt_files", "url string, kind string, stamp string, rows long, bytes long, collected_at timestamp, run_id long", [["url"]], "replace"),
    Table(
        "github_repositories",
        "id long, node_id string, full_name string, name string, owner string, owner_id long, owner_type string, description string, fork int, html_url string, api_url string, collected_at timestamp, run_id long",
        [["id"], ["full_name"]],
        "ignore",
    ),
    Table(
        "github_repository_snapshots",
        "repository_id long, observed_at timestamp, stars long, forks long, watchers long, open_issues long, size_kb long, language string, default_branch string, topics string, license string, archived int, "
        "created_at string, updated_at string, pushed_at string, run_id long",
        [["repository_id", "observed_at"]],
        "ignore",
    ),
    Table("github_events", "id string, type string, actor_id long, actor_login string, repo_id long, repo_name string, org_login string, public int, created_at string, payload string, collected_at timestamp, run_id long", [["id"]], "ignore"),
    Table("commoncrawl_crawls", "id string, name string, cdx_api string, from_at string, to_at string, collected_at timestamp", [["id"]], "replace"),
    Table(
        "commoncrawl_index",
        "id long, crawl string, surt string, url string, stamp string, fetched_at timestamp, status long, mime string, mime_detected string, charset string, languages string, digest string, length long, offset long, "
        "filename string, collected_at timestamp, run_id long",
        [["crawl", "surt", "stamp"]],
        "ignore",
        "id",
        ("id", "surt"),
    ),
    Table("commoncrawl_shards", "crawl string, shard string, lines long, bytes long, completed_at timestamp, run_id long", [["crawl", "shard"]], "replace"),
    Table(
        "commoncrawl_pages",
        "index_id long, crawl string, url string, stamp string, status int, content_type string, content_length long, title string, description string, language string, canonical_url string, link_count int, "
        "text_length long, text string, digest string, warc_filename string, warc_offset long, collected_at timestamp, run_id long",
        [["url", "digest"]],
        "ignore",
        zones=("index_id",),
    ),
]
#: Landed files that sources have read, each by its path and time.
_LANDED = Table("_landed_files", "source string, path string, modified timestamp, bytes long, run_id long", [["source", "path", "modified"]], "ignore")
TABLES: dict[str, Table] = {t.name: t for t in [*_TABLES, _LANDED]}
# Names of the steps of the store's layout, in order; the first has the tables named _*, others those of their prefix.
_STEPS = ["meta", "test", "rss", "gdelt", "github", "commoncrawl"]
#: Version, name and tables of each step; init() applies those that it hasn't yet.
MIGRATIONS: list[tuple[int, str, list[str]]] = [(i, n, [t.name for t in _TABLES if t.name.startswith("_" if n == "meta" else f"{n}_")]) for i, n in enumerate(_STEPS, 1)]
MIGRATIONS.append((len(MIGRATIONS) + 1, "landed_files", [_LANDED.name]))
