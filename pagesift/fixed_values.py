"""Values that results depend on: field names, word lists, markers and patterns."""

# --- fixed values: column names and their order -----------------------------------------------

CARD_COLUMNS = ["npsn", "nama_sekolah", "alamat_sekolah", "status_sekolah"]

PROFILE_COLUMNS = [
    "npsn", "url", "nama_sekolah", "alamat_sekolah", "alamat_jalan",
    "url_sk_operasional", "akreditasi", "kepala_sekolah", "telepon",
    "website", "status_sekolah", "bentuk_pendidikan", "operator",
    "email", "yayasan", "guru", "siswa_laki", "siswa_perempuan",
    "rombongan_belajar", "daya_tampung", "ruang_kelas", "laboratorium",
    "perpustakaan", "kurikulum", "penyelenggaraan", "akses_internet",
    "sumber_listrik", "daya_listrik", "luas_tanah", "rasio_siswa_rombel",
    "rasio_rombel_ruang_kelas", "rasio_siswa_guru", "persen_guru_kualifikasi",
    "persen_guru_sertifikasi", "persen_guru_pns", "persen_ruang_kelas_layak",
    "lintang", "bujur", "link_google_map",
]

# --- fixed values: sizes ------------------------------------------------------------------------

TOTAL_ROWS = 549_894
PAGE_SIZE = 48
LIST_BATCH_SIZE = 100
PROFILE_BATCH_SIZE = 50
MAX_COLUMN_WIDTH = 100

# --- fixed values: markers ----------------------------------------------------------------------

MISSING = "-"
BOM = "\ufeff"
TIMESTAMP_FORMAT = "yyyyMMdd_HHmmss"

# U+2014, U+2013, U+002D, U+2212, U+2015, U+2010, U+2011, U+2012
GENERAL_PLACEHOLDERS = [
    "—", "–", "-", "−", "―", "‐", "‑", "‒", "", " ",
]
PHONE_PLACEHOLDERS = ["—", "–", "-", "", " ", "−", "―"]
WEBSITE_PLACEHOLDERS = PHONE_PLACEHOLDERS + [
    "Belum Terisi", "Belum terisi", "belum terisi", "BELUM TERISI",
    "Tidak Ada", "tidak ada", "Tidak ada", "TIDAK ADA",
]

# --- fixed values: labels and keywords ------------------------------------------------------------

PROFILE_LABELS = {
    "akreditasi": "Akreditasi",
    "status_sekolah": "Status Sekolah",
    "bentuk_pendidikan": "Bentuk Pendidikan",
    "kepala_sekolah": "Kepala Sekolah",
    "operator": "Operator",
    "yayasan": "Yayasan",
}

UTILITY_LABELS = {
    "kurikulum": "Kurikulum",
    "penyelenggaraan": "Penyelenggaraan",
    "akses_internet": "Akses Internet",
    "sumber_listrik": "Sumber Listrik",
    "daya_listrik": "Daya Listrik",
    "luas_tanah": "Luas Tanah",
}

# field, words of which one must be in the lower-cased label, words that rule the label out;
# the first line that fits a label wins
STATISTIC_KEYWORDS = [
    ("guru", ["guru"], ["kualifikasi"]),
    ("siswa_laki", ["laki-laki", "laki laki"], []),
    ("siswa_perempuan", ["perempuan"], []),
    ("rombongan_belajar", ["rombongan", "rombel"], []),
    ("daya_tampung", ["daya tampung"], []),
    ("ruang_kelas", ["ruang kelas"], []),
    ("laboratorium", ["laboratorium"], []),
    ("perpustakaan", ["perpustakaan"], []),
]

OLDER_STATISTIC_KEYWORDS = [
    ("guru", ["guru"], []),
    ("siswa_laki", ["laki-laki"], []),
    ("siswa_perempuan", ["perempuan"], []),
    ("rombongan_belajar", ["rombongan", "rombel"], []),
    ("daya_tampung", ["daya tampung"], []),
    ("ruang_kelas", ["ruang kelas"], []),
    ("laboratorium", ["laboratorium"], []),
    ("perpustakaan", ["perpustakaan"], []),
]

LEARNING_KEYWORDS = [
    ("rasio_siswa_rombel", ["rasio siswa rombel"], []),
    ("rasio_rombel_ruang_kelas", ["rasio rombel ruang kelas"], []),
    ("rasio_siswa_guru", ["rasio siswa guru"], []),
    ("persen_guru_kualifikasi", ["guru kualifikasi"], []),
    ("persen_guru_sertifikasi", ["guru sertifikasi"], []),
    ("persen_guru_pns", ["guru pns"], []),
    ("persen_ruang_kelas_layak", ["ruang kelas layak"], []),
]

SECTION_STATISTICS = "Statistik Sekolah"
SECTION_UTILITIES = "Kurikulum"
SECTION_LEARNING = "Proses Pembelajaran"
SECTION_ADDRESS = "Alamat"

# --- fixed values: patterns -----------------------------------------------------------------------

# every blank that a Unicode-aware strip removes, as a set of characters and as a pattern class
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
BLANK_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"
NPSN_PATTERN = rf"NPSN{BLANK_CLASS}*:{BLANK_CLASS}*([\p{{L}}\p{{N}}_]+)"
PROFILE_ID_PATTERN = r"(?i)/profil-sekolah/([A-F0-9-]+)"
MAP_PATTERN = r"q=([-\p{Nd}.]+),([-\p{Nd}.]+)"
MAP_LINK = "https://www.google.com/maps?q="

# --- fixed values: markup rules ---------------------------------------------------------------------

# elements that never hold content
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# elements whose strings are not part of the page text
SPECIAL_STRING_ELEMENTS = frozenset(["script", "style", "template", "rt", "rp"])
KEEP_BLANKS_ELEMENTS = frozenset(["pre", "textarea"])
TEXT_KINDS = ["#text", "#cdata"]

# Characters that pages labelled windows-1252 or ISO-8859-1 mean by the bytes 0x80 to 0x9F (fixed values of the encoding).
WINDOWS_1252 = {b: bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
