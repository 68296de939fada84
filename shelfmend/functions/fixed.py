"""Values the connected systems expect literally. Nothing here is computed."""

# Services an outgoing message is meant for.
SEND_ADJUSTMENT = "EXP_INV_ADJUST"
SEND_PRESHIP = "EXP_PRE_SHIP"
SEND_RECEIPT = "EXP_RECEB"
SEND_ORDER_STATUS = "EXP_SOSTATUS"
SEND_UNDO = "EXP_DESFAZIMENTO"
SEND_CANCEL = "EXP_CANCEL_ORDER"
SEND_CANCEL_PARTIAL = "EXP_CANCEL_PARTIAL_ORDER"
PRINT_INVOICE = "EXP_PRINT_NF"
IMPORT_PO = "IMP_PO_ALLOC"

# Message and operation codes.
CANCEL_COMPLETE = "360"
CANCEL_PARTIAL = "361"
PICKED_UP = "340"
INVOICE = "936"
ADJUST = "192"
RELEASE = "750"
BLOCK = "700"
RECEIPT = "158"
STORE_RECEIPT = "164"
CUT = "033"
CUT_MARK = "PRO_E"

# User names the jobs write.
USER = "HJS"
USER_EQUALISE = "HJS_SG"
USER_RELEASE = "HJS_DISP"
USER_MANUAL_RELEASE = "HJS_CURSOR"
USER_CANCEL = "HJS_C"
USER_CUT = "HJS_CORTE"
USER_CANCEL_LIST = "HJS_REP"
USER_CANCEL_SENT = "HJS_COMP"
USER_SHIPINFO = "HJS_CUR"
USER_ERP_RECEIPT = "HJS_WSUP"
PRINTER = "il11405"

# Transfer contexts that mark goods as troubled stock.
TROUBLE_CONTEXTS = ("DEVTRI", "ACORDO", "SINFIS", "BUFFER", "TSFCST", "TSFDOA")

# Reply texts of the shipment service.
SUCCESS_PHRASE = "SuccessStatus"
ERROR_PHRASES = ("Cannot find dispatch method", "Familia não encontrada")

# Locations and location name parts.
NO_READING_AT = "RECE_TRANSF"
WATCHED_PARTS = ("CTN", "DISTCX")
WATCHED_PLACES = ("EST_REC_RS",)
RAIL_BUFFERS = ("RAIL_BUF1", "RAIL_BUF2")
PRE_RECEIPT = "PRE_RECE_TRANSF"
STORE_PREFIX = "CTN_LJ_"
STORE_STAGING = "EST_STG_SS"
STORE_RELATION = "CARTON_SHIP"
LOC_CLAIM = "LOC_RECEB_SI"
LOC_SETTLEMENT = "LOC_RECEB_IA"

# Operation code and description of each kind of log row; None is looked up.
LOG_EQUALISE = ("006", "Equalização RMS - Sala de Guerra")
LOG_RELEASE = ("035", "Equalização Non Sellable")
LOG_INCREMENT = ("009", "Incremento de Estoque")
LOG_STOCK_BACK = ("044", "Incremento de estoque")
LOG_STOCK_BACK_ADDED = ("044", "Incremento de estoque - UPD")
LOG_CLOSE_TASK = ("015", "Fechamento de tarefa")
LOG_GTIN = ("023", "Atualização GTIN")
LOG_SORTER_RETURN = ("024", "Retorno LPN Buffer")
LOG_CLIENT_MOVE = ("042", None)
LOG_INVOICE_SENT = ("071", "Interface PRE_SHIP (Corte)")
LOG_RESEND = ("086", "Reenvio ShipInfo")
LOG_SHIPINFO = ("088", "Shipinfo gerada normalmente ")
LOG_SPLIT = ("090", "Segregar UZs, Mono e Multi")
LOG_PLAN_MOVE = ("202", "Mov. Sistêmica")
LOG_CLAIM_STOCK = ("854", None)
LOG_CONSOLIDATE = ("999", "Agrupamento de estoque")
LOG_RESERVATION = ("999", "Atualização - Reserved/Control_number")
LOG_HOLD = ("999", "Correção - ")

# Code and description of each kind of exception row.
EXC_DUP_LOG = ("041", "Log Duplicado")
EXC_CONTAINER = ("874", "CONTAINER TYPE NULL")
EXC_DUP_PICK = ("973", "PKD Duplicada - PRE_RECE")
EXC_CUT = "Informação Base - Script de Corte"
EXC_WAVE = "Lojas não Liberadas"
EXC_WAVE_LINE = "Linha inexistente na PKD"
NEVER_READ = "SEM IN DATA"
