"""Word lists, patterns and formats for Indonesian hotel reviews.

They must stay as they are for results to agree with models and corpora built on them. Every
function takes its lexicon as an argument; these are the values to pass for this domain.
"""

from __future__ import annotations

# Slang and typo replacements.
SLANG = {
    "bgt": "banget",
    "recomend": "rekomendasi",
    "gk": "tidak",
    "ga": "tidak",
    "nginep": "menginap",
    "kmr": "kamar",
    "kmar": "kamar",
    "kamr": "kamar",
    "yg": "yang",
    "dgn": "dengan",
    "utk": "untuk",
    "sm": "sama",
    "jd": "jadi",
    "krn": "karena",
    "tp": "tapi",
    "bnyk": "banyak",
    "bersi": "bersih",
}

# Stopwords.
STOPWORDS = [
    "yang", "di", "ke", "dari", "dan", "atau", "ini", "itu", "saya", "kami",
    "anda", "untuk", "dengan", "pada", "adalah", "ada", "tidak", "juga",
    "saat", "akan", "sudah", "belum", "karena", "jadi", "tapi", "sangat",
    "sekali", "banget",
]

# Aspect -> (word beginnings, whole words), as regex alternatives.
ASPECT_STEMS = {
    "kebersihan": (["bersih", "kotor", "debu", "bau", "apek"], []),
    "pelayanan": (["pelayanan", "staf", "resepsionis", "ramah", "jutek", "check[- ]?in", "check[- ]?out"], []),
    "lokasi": (["lokasi", "strategis", "akses", "dekat", "jauh", "terpencil"], []),
    "fasilitas": (["fasilitas", "wifi", "kolam", "gym"], ["ac"]),
    "harga": (["harga", "mahal", "murah", "worth"], []),
    "sarapan": (["sarapan", "breakfast", "menu", "buffet"], []),
    "kamar": (["kamar", "kasur", "sprei", "view"], []),
    "parkir": (["parkir", "parkiran"], []),
}

# Aspect -> words marked as ASPECT in the token corpus.
ASPECT_WORDS = {
    "sarapan": ["sarapan", "menu", "makanan", "sajian", "cafe", "rooftop", "breakfast", "nasgor"],
    "lokasi": ["lokasi", "akses", "dekat", "jauh", "sepi", "strategis", "kemana_mana"],
    "fasilitas": ["fasilitas", "wifi", "lift", "taman", "lobi", "kolam", "playground"],
    "harga": ["harga", "bayar", "gratis", "murah", "mahal", "deposit"],
    "kamar": ["kamar", "ac", "kasur", "sprei", "tv", "mesin_cuci", "hair_dryer", "smooking_room"],
    "pelayanan": ["pelayanan", "layanan", "pegawai", "satpam", "staff", "ramah", "sopan", "customer"],
}

# Gazetteers.
HOTELS = [
    "Hotel Grand Candi", "Hotel Santika", "Hotel Aston", "Hotel Tentrem", "Hotel Ciputra",
    "Hotel Novotel", "Hotel Gumaya", "Hotel Patra Jasa", "Hotel Horison", "Hotel Ibis",
]
CITIES = [
    "Semarang", "Yogyakarta", "Bandung", "Surabaya", "Solo", "Bali", "Malang", "Jakarta", "Kuta", "Ubud",
]

# Carrier sentences for the token corpus.
TEMPLATES = [
    "Ulasan tamu di {hotel} {loc} : {snippet}",
    "Saya menginap di {hotel} di {loc} , {snippet}",
    "Pengalaman di {hotel} {loc} , {snippet}",
    "{snippet} , ini pendapat saya soal {hotel} di {loc}",
]

# Label vocabularies and the raw labels they come from.
ASPECT_LABELS = ["kamar", "lokasi", "fasilitas", "pelayanan", "sarapan", "harga"]
SENTIMENT_LABELS = ["positif", "negatif"]
ASPECT_MAP = {
    "kamar": "kamar",
    "lokasi": "lokasi",
    "hotel": "fasilitas",
    "pelayanan": "pelayanan",
    "restoran": "sarapan",
    "harga": "harga",
}
SENTIMENT_MAP = {"positive": "positif", "negative": "negatif"}

# Highlight colours and the span format.
ENTITY_COLORS = {"HOTEL": "#FDE68A", "LOC": "#A7F3D0", "ASPECT": "#BFDBFE"}
OTHER_COLOR = "#E5E7EB"
SPAN_FORMAT = (
    '<span style="background-color:%s; padding:2px 4px; border-radius:4px; margin:0 1px;" title="%s">%s</span>'
)

# Corpus sizes.
ROWS_PER_GROUP = 130
CORPUS_SENTENCES = 400
TEST_FRACTION = 0.2
SEED = 42

# Cell texts that a CSV reader of the pandas family takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
