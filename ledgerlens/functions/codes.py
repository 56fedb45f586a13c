"""Code sets and labels of the reporting views.

FIXED VALUES — these must equal the reporting rules being reproduced
(codes, labels and patterns are compared verbatim). They are kept here,
in their natural order, so every view and test reads the same list.
"""

# --- FIXED VALUES (begin) ---------------------------------------------------

# Language key of the text dimensions.
TEXT_LANGUAGE = "P"

# Header rows of item tables; main asset sub-number.
HEADER_ITEM = "000000"
MAIN_ASSET_SUBNUMBER = "0000"
DATE_SENTINEL = "0000-00-00"

# Pricing condition codes read by the reconciliation pivot.
RECONCILIATION_PRICE_CODES = [
    "PR00", "ICMI", "ZFRA", "ZEXC", "ZEXQ", "ZHVA", "ZHVQ", "ZHEX", "ZFRE", "RB00", "ZAVA", "ZSEG",
]
# Contract-item pivot: output measure -> condition code (SUM of the amount).
CONTRACT_ITEM_MEASURES = [
    ("preco_bruto", "ICMI"),
    ("seguro", "ZSEG"),
    ("franquia", "ZFRA"),
    ("preco", "PR00"),
    ("horas_exced", "ZEXC"),
    ("qnt_h_exc", "ZEXQ"),
    ("total_h_exc", "ZEXQ"),
    ("horas_variaveis", "ZHVA"),
    ("qnt_h_var", "ZHVQ"),
    ("total_h_var", "ZHVQ"),
    ("frete", "ZFRE"),
    ("desconto", "RB00"),
]
# Reconciliation pivot: output measure -> (condition code, value column), MAX.
RECONCILIATION_MEASURES = [
    ("preco_bruto", "ICMI", "kwert"),
    ("franquia", "ZFRA", "kwert"),
    ("horas_exced", "ZEXC", "kwert"),
    ("qnt_h_exc", "ZEXQ", "kbetr"),
    ("total_h_exc", "ZEXQ", "kwert"),
    ("horas_variaveis", "ZHVA", "kwert"),
    ("qnt_h_var", "ZHVQ", "kbetr"),
    ("total_h_var", "ZHVQ", "kwert"),
    ("total_h_extra", "ZHEX", "kwert"),
    ("frete", "ZFRE", "kwert"),
    ("desconto", "RB00", "kwert"),
    ("avaria", "ZAVA", "kwert"),
    ("seguro", "ZSEG", "kwert"),
]
LATEST_PRICE_CODE = "PR00"
INACTIVE_FLAG = "X"
# Used-sales pivot.
USED_SALES_MEASURES = [("preco_c_juros", "ZPRJ"), ("preco_liquido", "ZPRL")]

# Invoice header types.
BILLED_INVOICE_TYPES = ["ZSER", "ZLOC", "ZCTE", "ZSSM", "ZLSM"]
CANCELLATION_INVOICE_TYPES = ["S1", "S2"]
# Order item categories of the reconciliation.
ORDER_ITEM_CATEGORIES = ["ZSER", "ZLOC", "ZSSM", "ZCTE"]
# Used-sale item categories: one sale, two returns.
USED_SALE_CATEGORY = "ZVAT"
USED_SALES_CATEGORIES = ["ZVAT", "ZDAT", "ZRAT"]
# Rental-invoice item categories.
RENTAL_INVOICE_CATEGORIES = ["ZSIM", "ZDSR", "ZROB", "ZDNP", "ZREB"]
# Receipt document types, credit side, clearing reversal flag.
RECEIPT_DOC_TYPES = ["DZ", "ZB", "ZR"]
RECEIPT_SIDE = "H"
# Accounting line of a billing document.
ACCOUNTING_PROCESS = "SD00"
ACCOUNTING_FIRST_ITEM = "001"
# Partner functions: invoice representative, billing lead, seller.
PARTNER_INVOICE_REP = "ZF"
PARTNER_BILLING_LEAD = "ES"
PARTNER_SELLER = "ZV"
# Document categories.
DOC_CONTRACT = "G"
DOC_ORDER = "C"
DOC_RETURN = "H"
FLOW_INVOICE = "M"

# Profit centre shown under a fixed name.
DUMMY_PROFIT_CENTRE = "ARM3"
DUMMY_PROFIT_CENTRE_NAME = "ARMAC - Dummy"

# Item charge type from the item text (case-insensitive, first hit wins).
CHARGE_TYPE_PATTERNS = [
    ("avaria", "Avarias"),
    ("Prote|Seguro", "Seguro"),
    ("Frete|Mob", "Fretes"),
]
RECURRING_CHARGE_TYPES = ["Máquina", "Implementos", "Seguro"]
RENTAL_CHARGE_TYPES = ["Máquina", "Implementos"]
OTHER_CHARGE_TYPES = ["Outros", "MO"]
MACHINE = "Máquina"
INSURANCE = "Seguro"
FREIGHT = "Fretes"
DAMAGE = "Avarias"
UNDUE_MATERIAL = "Indevido"
FULL_MONTH_DAYS = 30

# Charge frequency / mode labels.
RECURRING = "Recorrente"
ONE_OFF = "Única"
MODE_FULL = "Integral"
MODE_MOBILISATION = "Proporcional Mobilização"
MODE_DEMOBILISATION = "Proporcional Desmobilização"
YES = "Sim"
NO = "Não"

# Order / contract status labels.
ORDER_PENDING = "FAT. PENDENTE"
ORDER_BILLED = "FATURADO"
ORDER_NO_MEASUREMENT = "BM PENDENTE"
ORDER_STATUS_MAP = [("A", "FAT. PENDENTE"), ("B", "FATURADO"), ("C", "FATURADO")]
CONTRACT_STATUS_MAP = [("A", "PENDENTE"), ("B", "EM PROCESSAMENTO"), ("C", "CONCLUÍDO")]
SALE_LABEL = "FATURADO"
RETURN_LABEL = "DEVOLVIDO"
ITEM_ACTIVE = "Ativo"
ITEM_INACTIVE = "Inativo"
PLACEHOLDER_YEARS = [1900, 1990]
LONG_TERM = "LONGO PRAZO"

# Device-return status.
DEVICE_RETURNED = "Devolvido"
DEVICE_IN_USE = "Em Uso"
DEVICE_NOT_FOUND = "Não Encontrado"

# Contract type from order type (contract items use the first three,
# the reconciliation all four).
ORDER_TYPE_CONTRACT = [
    ("ZVA", "SPOT - VAREJO"),
    ("ZGC", "SPOT - GRANDES CONTAS"),
    ("ZLP", "LONGO PRAZO"),
    ("ZCS", "SPOT - CONSORCIO"),
]
# Contract type from profit centre: marker substring, then 4th character.
PROFIT_CENTRE_MARKER = "ARM3"
PROFIT_CENTRE_CHAR_POS = 4
PROFIT_CENTRE_CHAR_MAP = [
    ("1", "LONGO PRAZO"),
    ("2", "LONGO PRAZO"),
    ("3", "SPOT - GRANDES CONTAS"),
    ("4", "SPOT - VAREJO"),
    ("T", "SPOT - GRANDES CONTAS"),
]

# Customer group -> business vector.
CUSTOMER_GROUP_MAP = [
    ("ZA", "Biomassa"),
    ("ZB", "Cidades Ferroviárias"),
    ("ZC", "Consórcio"),
    ("ZD", "Corporativo"),
    ("ZE", "Empilhadeiras"),
    ("ZF", "Florestal & Siderurgia"),
    ("ZG", "Mineração"),
    ("ZH", "Mix de Projetos"),
    ("ZI", "Rental"),
    ("ZJ", "Vale"),
    ("ZK", "Yara / VLI / Mosaic"),
]
# Machine location status code -> label.
DEVICE_LOCATION_MAP = [
    ("1", "Ativo à Venda"),
    ("2", "Ativo Inativado"),
    ("3", "Auditoria UCA"),
    ("4", "Catalão - GO"),
    ("5", "Compras de Novos - Aguardando"),
    ("6", "Em Clientes"),
    ("7", "Em Trânsito"),
    ("8", "Ouro Preto - MG"),
    ("9", "Paranaguá - PR"),
    ("10", "Reservado"),
    ("11", "Rio Grande do Sul - RS"),
    ("12", "Rondonópolis - MT"),
    ("13", "Serviço em Terceiros"),
    ("14", "VGP 1 - SP"),
    ("15", "VGP 2 - SP"),
    ("16", "VGP 3 - SP"),
    ("17", "VGP 5 - SP"),
    ("18", "Vila Velha - ES"),
]

# Asset register.
ASSET_VALUE_AREA = "01"
ASSET_EXCLUDED_PREFIXES = [
    "00", "AD", "AG", "CB", "EI", "EL", "FE", "FO", "GD", "MP", "MT", "OP", "ON", "PÇ", "TS", "TN",
]
ASSET_CHASSIS_FALLBACK_PREFIXES = ["ID", "IM", "IR", "VS"]
ASSET_COMPOSITE_PREFIX = "CM"
EQUIPMENT_STATUS_PROFILE = "ZPM_M_V"
HOUR_METER_POINT = "HORIMETRO ACUMULADO"
FIRST_RANK = "1"

# Material dimension rows left out of the reconciliation.
MATERIAL_TYPE_NULL_TEXT = "null"
MATERIAL_GROUP_PARTS = "PEÇAS"

# Reconciliation date windows: floor of header months, floor of contract
# lines, and the contract-specific exception windows (contract, from, to).
HEADER_MONTH_FLOOR = "2022-01-01"
LINE_MONTH_FLOOR = "2024-01-01"
LINE_EXCEPTION_WINDOWS = [
    ("0040000270", "2022-11-01", "2022-12-21"),
    ("0040000413", "2023-06-01", "2023-06-30"),
    ("0040001234", "2023-12-01", "2023-12-31"),
]
MONTHS_AHEAD = 2
# Orders whose number starts with this prefix are their own contract.
CONTRACT_NUMBER_PREFIX = "004"
# Extraction stamps are stored in UTC and reported 3 hours earlier.
EXTRACTION_HOUR_SHIFT = 3

# --- FIXED VALUES (end) -----------------------------------------------------
