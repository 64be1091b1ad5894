"""Fixed values that results depend on: lookup tables, word lists and limits, in their natural order."""

from __future__ import annotations

# Spanish and English names of property types and the canonical type of each.
TIPO = {
    "apartamento": "apartamento",
    "apto": "apartamento",
    "departamento": "apartamento",
    "casa": "casa",
    "apartaestudio": "apartaestudio",
    "local": "local",
    "comercial": "local",
    "oficina": "oficina",
    "bodega": "bodega",
    "lote": "lote",
    "terreno": "lote",
    "finca": "finca",
    "hacienda": "finca",
    "apartment": "apartamento",
    "department": "apartamento",
    "house": "casa",
    "studio": "apartaestudio",
    "commercial": "local",
    "office": "oficina",
    "warehouse": "bodega",
    "lot": "lote",
    "farm": "finca",
}

# How portals describe garages, and the places that means.
GARAJE = {
    "si": 1,
    "si.": 1,
    "sí": 1,
    "cubierto": 1,
    "semicubierto": 1,
    "zona de parqueo": 1,
    "descubierto": 1,
    "doble": 2,
    "doble en paralelo": 2,
    "doble lineal": 2,
    "no": 0,
    "no.": 0,
    "sin garaje": 0,
    "sin": 0,
    "": 0,
}

# Roman numerals of the socio-economic levels.
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6}

# The standard types, those that are exported, and the least exported price.
STANDARD_TIPOS = ("apartamento", "casa", "apartaestudio", "local", "oficina", "bodega", "lote", "finca")
EXPORT_TIPOS = ("apartamento", "apto", "casa", "casa-finca", "casa unifamiliar")
EXPORT_LEAST = 200_000

# Texts that stand for a missing value in a CSV, as they are spelled.
MARKERS = ("N/A", "null", "None", "-1", "nan", "NA", "n/a", "none")

# English property types of a portal's detail pages.
DETAIL_TIPO = {
    "apartment": "apartamento",
    "house": "casa",
    "single-room": "apartaestudio",
    "studio": "apartaestudio",
    "office": "oficina",
    "farm": "finca",
    "lot": "lote",
    "store": "local",
    "establishment": "local",
    "duplex": "casa",
    "cabin": "casa",
    "garage": "local",
    "condominium": "apartamento",
    "consulting": "oficina",
}

# Portals with their id prefix, least number of listings and script name.
PORTALS = (
    ("maxibienes", "MXB", 30, None),
    ("albertoalvarez", "AAL", 50, None),
    ("alnago", "ALN", 5, None),
    ("arrendamientosdelnorte", "ADN", 100, "adn"),
    ("arrendamientosmonserrate", "MNS", 20, "monserrate"),
    ("arrendamientossantafe", "ASF", 30, "asf"),
    ("arrendamientosvillacruz", "AVC", 30, "villacruz"),
    ("coninsa", "CON", 150, None),
    ("habitamos", "HBM", 100, None),
    ("merinohermanos", "MHR", 70, None),
    ("metrocasas", "MTC", 5, None),
    ("santillana", "STL", 30, None),
)

# Residential types kept from one portal, and types renamed at two.
RESIDENTIAL = ("Apartamento", "Casa", "Casa finca")
RENAMED = {"Casa finca": "casa"}
RENAMED_LOWER = {"casa vivienda": "casa"}

# Icon classes and the fields they mark.
ICONS = {"fa-compress": "area", "fa-bed": "habitaciones", "fa-bath": "banos", "fa-warehouse": "parqueaderos"}

# Labels on detail pages of one portal and their fields; a colon may follow each.
DETAIL_LABELS = {
    "tipo de inmueble": "tipo",
    "área": "area",
    "alcobas": "habitaciones",
    "baños": "banos",
    "garaje": "parqueaderos",
    "estrato": "estrato",
    "sector": "barrio",
    "código": "codigo",
    "codigo": "codigo",
}

# Labels of home-page cards of one portal.
CARD_LABELS = {
    "zona": "zona",
    "finalidad": "finalidad",
    "precio": "precio",
    "cod:": "codigo",
    "cod": "codigo",
    "bedrooms": "bedrooms",
    "bathrooms": "bathrooms",
    "garages": "garages",
}

# Closing tags (and br) after which a line ends, in the two text conversions by pattern.
LINE_TAGS = ("</div>", "</p>", "</section>", "</article>", "<br", "</li>", "</tr>", "</td>", "</h1>", "</h2>", "</h3>", "</h4>", "</h5>", "</h6>")

# Elements that the text conversion by parser leaves out, and those that begin and end lines in it.
SKIPPED_TAGS = ("script", "style", "noscript", "iframe")
BREAK_TAGS = ("div", "p", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "dl", "dt", "dd")

# Cities under other spellings, and the labels of card features of one portal, in the order they are tried.
CITIES = {"medellin": "Medellín", "medellín": "Medellín", "bogota": "Bogotá", "bogotá": "Bogotá"}
FEATURES = {
    "habitaciones": ("Bedrooms:", "Habitaciones:", "habitaciones:", "Alcobas:", "alcobas:"),
    "banos": ("Bathrooms:", "Baños:", "baños:", "Banos:", "banos:"),
    "parqueaderos": ("Garage:", "Garaje:", "garaje:", "Parqueadero:", "Parqueaderos:"),
}
SALE_LABELS = ("Sale price:", "For Sale:", "For sale:")
RENT_LABELS = ("Rental price:", "rental price:", "Rental Price:")
CODE_LABELS = ("Code:", "Código:", "Codigo:")

# Words in a barrio, in an id and for a transaction that the loader takes for a parsing error.
BARRIO_ARTIFACTS = ("código", "code:", "arriendo", "$", "rent:")
ID_ARTIFACTS = ("rent:", "sale:", "$")
TRANSACTIONS = ("arriendo", "venta", "for lease", "for sale")

# An end-of-list text, a placeholder code, a database setting that dumps can't read.
NO_MORE = "There are no properties"
STALE_CODE = "A9692"
DROPPED_PARAMETER = "channel_binding"
