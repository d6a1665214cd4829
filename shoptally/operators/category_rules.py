"""Keyword rules, category aliases and the labels used when neither applies."""

# Keyword -> category, tried in this order; the first keyword found in the text wins.
KEYWORD_RULES = (
    ("FOTOCOPIA", "FOTOCOPIA E IMPRESION"),
    ("IMPRESION", "FOTOCOPIA E IMPRESION"),
    ("TIPEO", "SERVICIOS"),
    ("LAPICERO", "LAPICERO"),
    ("PORTAMINAS", "LAPIZ"),
    ("LAPIZ", "LAPIZ"),
    ("CARBONCILLO", "LAPIZ"),
    ("PLUMON", "PLUMON / RESALTADOR"),
    ("RESALTADOR", "PLUMON / RESALTADOR"),
    ("CHEQUEO", "PLUMON / RESALTADOR"),
    ("MARKER", "PLUMON / RESALTADOR"),
    ("INDELEBLE", "PLUMON / RESALTADOR"),
    ("CORRECTOR", "CORRECTOR"),
    ("MINAS", "MINAS / REPUESTOS"),
    ("CRAYON", "CRAYOLAS"),
    ("COLORES", "COLORES"),
    ("TEMPERA", "TEMPERA"),
    ("PINCEL", "PINCEL"),
    ("PALETA", "ACCESORIOS DE PINTURA"),
    ("PLASTILINA", "PLASTILINA"),
    ("LENTEJUELA", "LENTEJUELAS Y ESCARCHA"),
    ("ESCARCHA", "LENTEJUELAS Y ESCARCHA"),
    ("OROPEL", "PAPEL OROPEL"),
    ("MICROPOROSO", "MICROPOROSO"),
    ("BAJA LENGUA", "PALITOS DE MANUALIDADES"),
    ("PALITOS DE CHUPETE", "PALITOS DE MANUALIDADES"),
    ("OJOS MOVILES", "MANUALIDADES"),
    ("PUNZON", "HERRAMIENTAS DE MANUALIDADES"),
    ("ALGODON", "ALGODON"),
    ("SILICONA", "SILICONA"),
    ("GOMA", "GOMA"),
    ("LIMPIATIPO", "LIMPIATIPOS"),
    ("CINTA MASKING", "CINTA ADHESIVA / EMBALAJE"),
    ("CINTA EMBALAJE", "CINTA ADHESIVA / EMBALAJE"),
    ("CINTA DE ESCRITORIO", "CINTA ADHESIVA / EMBALAJE"),
    ("CINTA DE AGUA", "CINTAS DECORATIVAS Y AGUA"),
    ("SKETCH BOOK", "BLOCK / SKETCH BOOK"),
    ("SKETCHBOOK", "BLOCK / SKETCH BOOK"),
    ("BLOCK", "BLOCK / SKETCH BOOK"),
    ("CUADERNO", "CUADERNO"),
    ("POST-IT", "NOTAS ADHESIVAS / POST-IT"),
    ("PAPEL BOND", "HOJA BOND"),
    ("HOJA BOND", "HOJA BOND"),
    ("HOJA DE COLOR", "HOJAS DE COLORES"),
    ("CARTULINA", "CARTULINA"),
    ("PAPEL CREPE", "PAPEL CREPE"),
    ("PAPEL LUSTRE", "PAPEL LUSTRE"),
    ("PAPEL KRAFT", "PAPEL ESPECIAL / KRAFT"),
    ("PAPEL CRAFT", "PAPEL ESPECIAL / KRAFT"),
    ("PAPEL DE SEDA", "PAPEL DE SEDA"),
    ("PAPEL DE SEDE", "PAPEL DE SEDA"),
    ("PAPELOTE", "PAPELOTE"),
    ("SOBRE", "SOBRE"),
    ("FOLDER", "FOLDER"),
    ("MICA", "MICA / FOTOCHECK"),
    ("PLASTIFORRO", "FORRO / VINIFAN"),
    ("VINIFAN", "FORRO / VINIFAN"),
    ("FASTER", "SUJETADORES / FASTERS"),
    ("CHINCHE", "SUJETADORES / CHINCHES"),
    ("GRAPA", "SUJETADORES / GRAPAS"),
    ("LIGAS", "SUJETADORES / LIGAS"),
    ("PABILO", "PABILO"),
    ("TIJERA", "TIJERA / CUTER"),
    ("CUTER", "TIJERA / CUTER"),
    ("TAJADOR", "TAJADOR"),
    ("BORRADOR", "BORRADOR"),
    ("REGLA", "REGLA / GEOMETRIA"),
    ("ESCUADRA", "REGLA / GEOMETRIA"),
    ("TRANSPORTADOR", "REGLA / GEOMETRIA"),
    ("PERFORADOR", "PERFORADOR"),
    ("CALCULADORA", "CALCULADORA"),
    ("MOTA", "MOTA"),
    ("TAMPON", "TAMPON Y TINTAS"),
    ("TINTA", "TAMPON Y TINTAS"),
    ("GLOBO", "GLOBOS Y ACCESORIOS"),
    ("PALIGLOBO", "GLOBOS Y ACCESORIOS"),
    ("SERPENTINA", "SERPENTINA Y PICA PICA"),
    ("PICA PICA", "SERPENTINA Y PICA PICA"),
    ("FLAUTA", "INSTRUMENTOS MUSICALES"),
    ("CORBATA", "ARTICULOS CIVICOS Y UNIFORME"),
    ("ESCARAPELA", "ARTICULOS CIVICOS Y UNIFORME"),
    ("BANDERA", "ARTICULOS CIVICOS Y UNIFORME"),
    ("INSIGNA", "ARTICULOS CIVICOS Y UNIFORME"),
    ("BRIGADIER", "ARTICULOS CIVICOS Y UNIFORME"),
    ("CORREA", "ARTICULOS CIVICOS Y UNIFORME"),
    ("GUANTE", "GUANTES E HIGIENE"),
    ("MANDIL", "MANDIL Y BOLSA"),
    ("BOLSA", "MANDIL Y BOLSA"),
    ("SUPER BLUE", "ACCESORIOS DE LIMPIEZA"),
)

# Inventory category -> category, used when no keyword is found.
CATEGORY_ALIASES = {
    "LAPICEROS": "LAPICERO",
    "PLUMONES": "PLUMON / RESALTADOR",
    "RESALTADORES": "PLUMON / RESALTADOR",
    "INDELEBLE": "PLUMON / RESALTADOR",
    "TEMPERAS": "TEMPERA",
    "GOMAS": "GOMA",
    "SILICONAS": "SILICONA",
    "PINCELES": "PINCEL",
    "REGLAS": "REGLA / GEOMETRIA",
    "TIJERAS": "TIJERA / CUTER",
    "BORRADORES": "BORRADOR",
    "TAJADORES": "TAJADOR",
    "CUADERNOS": "CUADERNO",
    "CARTULINAS": "CARTULINA",
    "CRAYOLA": "CRAYOLAS",
    "CRAYOLAS": "CRAYOLAS",
    "CINTAS EMBALAJE": "CINTA ADHESIVA / EMBALAJE",
    "CINTAS": "CINTA ADHESIVA / EMBALAJE",
    "PAPELERIA": "GENERAL / OTROS",
    "UTILES": "GENERAL / OTROS",
    "UNIDAD": "GENERAL / OTROS",
    "COPIA": "FOTOCOPIA E IMPRESION",
    "COPIAS": "FOTOCOPIA E IMPRESION",
    "IMPRESION": "FOTOCOPIA E IMPRESION",
    "HOJA DE COLORES": "HOJAS DE COLORES",
    "ESCHARCHAS": "LENTEJUELAS Y ESCARCHA",
    "ESCARCHAS": "LENTEJUELAS Y ESCARCHA",
}

# Labels and inventory categories that always need review.
PENDING = "PENDIENTE_REVISION"
BY_DESCRIPTION = "DESCRIPCION"
BY_INVENTORY = "INVENTARIO"
UNMAPPED = "OTRO"
INVALID_CATEGORIES = ("", "-", "TAILOY")
