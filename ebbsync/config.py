"""One typed object for every parameter of the updater."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults of the service being reproduced.
DEFAULT_NAMESPACES = "120,122,146"
DEFAULT_SCHEME = "https"
DEFAULT_BATCH_SIZE = 20
DEFAULT_DAYS_BACK = 90
ENTITY_NAMESPACE_SLOTS = {"item": "120/main", "property": "122/main"}


@dataclass(frozen=True)
class UpdaterConfig:
    """Settings of a service run or a one-off run.

    ``namespaces`` is the CSV of allowed entity namespaces, ``namespace_slots``
    maps an entity type to ``<namespace>/<slot>``. ``pass_limit`` counts the
    passes of this process: -1 runs without a limit; 0 and every other negative
    value runs no pass.
    ``langs``, ``single_label`` and ``skip_links`` clean the facts and are off
    by default in both modes.
    """

    interval_s: int = 0
    pass_limit: int = -1
    namespaces: str = DEFAULT_NAMESPACES
    namespace_slots: tuple[tuple[str, str], ...] = tuple(ENTITY_NAMESPACE_SLOTS.items())
    scheme: str = DEFAULT_SCHEME
    ingress: str | None = None
    langs: tuple[str, ...] = ()
    single_label: bool = False
    skip_links: bool = False
    batch_size: int = DEFAULT_BATCH_SIZE
    days_back: int = DEFAULT_DAYS_BACK
    verify: bool = False
    dump_dir: str | None = None
    feed_format: str = "files"
    # Most files a pass takes up; without a limit a backlog is one pass, which
    # reads the store once instead of many times.
    max_files_per_trigger: int | None = None
    # Parts of the log of about the same size that the service merges into one; 1 writes a
    # new base after every pass, 0 never merges.
    compact_every: int = 8
    # Merged epochs that the service leaves for readers of older states.
    keep_epochs: int = 100
    # Answers after which a batch that is not done is set aside instead of queued again; 0 never is.
    max_tries: int = 0
    max_records_per_file: int = 5_000_000
    # Largest key set that is broadcast, in rows and in bytes; a larger one is joined by shuffle.
    broadcast_rows: int = 200_000
    broadcast_bytes: int = 64_000_000
    # Most wikis of a pass for which its tables are filtered by listing them.
    prune_tenants: int = 1_000
    # Most subjects of a pass for which they and their buckets are listed.
    prune_subjects: int = 1_000

    def __post_init__(self):
        if self.interval_s < 0:
            raise ValueError("interval_s must not be negative")
        if self.max_tries < 0:
            raise ValueError("max_tries must not be negative")
        if self.batch_size < 1:
            raise ValueError("batch_size must be positive")
        if self.single_label and not self.langs:
            raise ValueError("single_label needs langs, its order of preference")
