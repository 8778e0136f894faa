"""What a run is told: where the directory lives, which pages to cover, how to cut batches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pagesift import fixed_values as fv


@dataclass(frozen=True)
class SiteConfig:
    """Hosts of the directory; pass the portal's own domain for real snapshots."""

    domain: str = "example.go.id"

    @property
    def base_url(self) -> str:
        return f"https://sekolah.data.{self.domain}"

    @property
    def registry_host(self) -> str:
        return f"referensi.data.{self.domain}"

    @property
    def document_base(self) -> str:
        return f"https://file.data.{self.domain}/sk/"


@dataclass(frozen=True)
class RunConfig:
    """One run over a page range. Calls with the same ``run_id`` and ``work_dir`` continue each other.

    ``max_pages`` counts from ``start_page`` (relative limit); ``last_page`` is a page number
    the plan never passes (absolute limit, so that a resumed run gets no extra pages).
    ``pages_per_commit`` cuts a pass into page ranges that are committed one after the other, so
    that a run that is stopped loses no more than one range. ``batch_files`` writes the rows in files
    of ``batch_size`` as the commits bring them. ``profile_ranges`` cuts a pass over profile pages into as
    many commits, by a hash of the URL; every one of them reads the snapshots once.
    """

    run_id: str
    work_dir: str
    site: SiteConfig = field(default_factory=SiteConfig)
    start_page: int = 0
    max_pages: int | None = None
    last_page: int | None = None
    total_rows: int = fv.TOTAL_ROWS
    page_size: int = fv.PAGE_SIZE
    batch_size: int = fv.LIST_BATCH_SIZE
    batch_files: bool = False
    stop_at_empty_page: bool = False
    pages_per_commit: int | None = None
    profile_ranges: int = 1
