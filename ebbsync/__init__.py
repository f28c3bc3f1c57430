"""Change-feed sync for many tenants, written as Spark jobs."""

from ebbsync.config import UpdaterConfig
from ebbsync.plans.update import Sources, catch_up, run_once, update_pass
from ebbsync.session import configure, work_dir
from ebbsync.sources.store import Store
from ebbsync.streaming.updater import Updater, start_updater

__all__ = [
    "Sources",
    "Store",
    "Updater",
    "UpdaterConfig",
    "catch_up",
    "configure",
    "run_once",
    "start_updater",
    "update_pass",
    "work_dir",
]
