"""Code-to-label tables and the expression that applies them.

The tables are constants, so they are applied as one lookup in a literal map
inside the projection: no join, nothing to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels shown for the codes of the tax documents.
DOCUMENT_SITUATION = {
    "00": "Documento regular",
    "01": "Escrituração extemporânea de documento regular",
    "02": "Documento cancelado",
    "03": "Escrituração extemporânea de documento cancelado",
    "04": "NF-e, NFC-e ou CT-e - denegado",
    "05": "NF-e, NFC-e ou CT-e - Numeração inutilizada",
    "06": "Documento Fiscal Complementar",
    "07": "Escrituração extemporânea de documento complementar",
    "08": "Documento Fiscal emitido com base em Regime Especial ou Norma Específica",
}
DOCUMENT_SITUATION_SHORT = {**DOCUMENT_SITUATION, "08": "Documento Fiscal emitido com base em Regime Especial"}
DIRECTION = {"0": "0 - Entrada", "1": "1 - Saída"}
DIRECTION_SHORT = {"0": "ENTRADA", "1": "SAÍDA"}
ISSUER = {"0": "0 - Emissão própria", "1": "1 - Terceiros"}
ISSUER_SHORT = {"0": "Emissão própria", "1": "Terceiros"}
PAYMENT = {"0": "0 - a vista", "1": "1 - a prazo", "2": "2 - outros", "9": "9 - Sem pagamento"}
FREIGHT = {"0": "0 - Emitente", "1": "1 - Destinatário", "2": "2 - Terceiros", "9": "9 - Sem frete"}
FILE_PURPOSE = {"0": "0 - Original", "1": "1 - Substituto"}
FILE_PURPOSE_LONG = {"0": "0 - Remessa do arquivo original", "1": "1 - Remessa do arquivo substituto"}
FILE_PURPOSE_PLAIN = {"0": "Remessa do arquivo original", "1": "Remessa do arquivo substituto"}
INVENTORY_REASON = {
    "01": "01 - No final do período",
    "02": "02 - Mudança de tributação (ICMS)",
    "03": "03 - Baixa cadastral/paralisação temporária",
    "04": "04 - Alteração de regime de pagamento",
    "05": "05 - Por determinação dos fiscos",
    "06": "06 - Controle ST - restituição/ressarcimento",
}
REFUND_REASON = {
    "1": "1 - Saida para outra UF",
    "2": "2 - Isencao ou nao incidencia",
    "3": "3 - Perda ou deterioracao",
    "4": "4 - Furto ou roubo",
    "5": "5 - Exportacao",
    "6": "6 - Venda interna p/ Simples Nacional",
    "9": "9 - Outros",
}
ITEM_TYPE = {
    "00": "Mercadoria para Revenda",
    "01": "Matéria-prima",
    "02": "Embalagem",
    "03": "Produto em Processo",
    "04": "Produto Acabado",
    "05": "Subproduto",
    "06": "Produto Intermediário",
    "07": "Material de Uso e Consumo",
    "08": "Ativo Imobilizado",
    "09": "Serviços",
    "10": "Outros insumos",
    "99": "Outras",
}
ITEM_TYPE_NUMBERED = {code: f"{code} - {label}" for code, label in ITEM_TYPE.items()}
GENUS_SHORT = {"00": "Serviço", "01": "Animais vivos"}
GENUS = {
    "00": "Serviço",
    "01": "Animais vivos",
    "02": "Carnes e miudezas, comestíveis",
    "03": "Peixes e crustáceos, moluscos e os outros invertebrados aquáticos",
    "04": "Leite e laticínios, ovos de aves e outros produtos comestíveis de origem animal",
    "05": "Outros produtos de origem animal",
    "06": "Plantas vivas e produtos de floricultura",
    "07": "Produtos hortícolas, raízes e tubérculos comestíveis",
    "08": "Frutas, cascas de cítricos e de melões",
    "09": "Café, chá, mate e especiarias",
    "10": "Cereais",
    "11": "Produtos da indústria de moagem",
    "12": "Sementes e frutos oleaginosos",
    "13": "Gomas, resinas e extratos vegetais",
    "14": "Matérias para entrançar e outros produtos vegetais",
    "15": "Gorduras de origem animal ou vegetal",
    "16": "Preparações de carne e outros produtos de origem animal",
    "17": "Açúcares e produtos de confeitaria",
    "18": "Cacau e suas preparações",
    "19": "Preparações à base de cereais e produtos de pastelaria",
    "20": "Preparações de produtos hortícolas, frutas ou outras partes de plantas",
    "21": "Preparações alimentícias diversas",
    "22": "Bebidas, líquidos alcoólicos e vinagres",
    "23": "Resíduos e desperdícios das indústrias alimentares",
    "24": "Fumo (tabaco) e seus sucedâneos",
    "25": "Sal, enxofre, terras e pedras",
    "26": "Minérios, escórias e cinzas",
    "27": "Combustíveis minerais e óleos minerais",
    "28": "Produtos químicos inorgânicos",
    "29": "Produtos químicos orgânicos",
    "30": "Produtos farmacêuticos",
    "31": "Adubos ou fertilizantes",
    "32": "Extratos tanantes e tintas de escrever",
    "33": "Óleos essenciais e resinoides",
    "34": "Sabões, agentes orgânicos de superfície e produtos semelhantes",
    "35": "Matérias albuminóides e enzimas",
    "36": "Pólvoras e explosivos",
    "37": "Produtos para fotografia e cinematografia",
    "38": "Produtos diversos das indústrias químicas",
    "39": "Plásticos e suas obras",
    "40": "Borracha e suas obras",
    "41": "Peles, exceto a peleteria",
    "42": "Obras de couro",
    "43": "Peleteria",
    "44": "Madeira, carvão vegetal e obras de madeira",
    "45": "Cortiça e suas obras",
    "46": "Obras de espartaria ou cestaria",
    "47": "Pastas de madeira e celulose",
    "48": "Papel e cartão",
    "49": "Livros, jornais e impressos",
    "50": "Seda",
    "51": "Lã e pelos finos",
    "52": "Algodão",
    "53": "Outras fibras têxteis vegetais",
    "54": "Filamentos sintéticos ou artificiais",
    "55": "Fibras sintéticas ou artificiais descontínuas",
    "56": 'Pastas ("ouates"), feltros e falsos tecidos',
    "57": "Tapetes e outros revestimentos para pavimentos",
    "58": "Tecidos especiais, tecidos tufados",
    "59": "Tecidos impregnados",
    "60": "Tecidos de malha",
    "61": "Vestuário e acessórios de malha",
    "62": "Vestuário e acessórios, exceto de malha",
    "63": "Outros artefatos têxteis",
    "64": "Calçados e artefatos semelhantes",
    "65": "Chapéus e artefatos de uso semelhante",
    "66": "Guarda-chuvas, bengalas e semelhantes",
    "67": "Penas e penugem preparadas",
    "68": "Produtos cerâmicos",
    "69": "Obras de pedra",
    "70": "Vidro e suas obras",
    "71": "Pérolas naturais ou cultivadas",
    "72": "Ferro fundido, ferro ou aço",
    "73": "Obras de ferro fundido",
    "74": "Cobre e suas obras",
    "75": "Níquel e suas obras",
    "76": "Alumínio e suas obras",
    "77": "[Reservado]",
    "78": "Chumbo e suas obras",
    "79": "Zinco e suas obras",
    "80": "Estanho e suas obras",
    "81": "Outros metais comuns",
    "82": "Ferramentas e utensílios",
    "83": "Obras diversas de metais comuns",
    "84": "Máquinas, aparelhos e material elétrico",
    "85": "Veículos automóveis",
    "86": "Aeronaves e aparelhos espaciais",
    "87": "Instrumentos e aparelhos",
    "88": "Embarcações e estruturas flutuantes",
    "89": "Instrumentos musicais",
    "90": "Instrumentos e aparelhos ópticos",
    "91": "Aparelhos de relojoaria",
    "92": "Armas e munições",
    "93": "Brinquedos",
    "94": "Móveis",
    "95": "Obras de arte e coleções",
    "96": "Diversos",
    "97": "Reservado",
    "98": "Operações especiais",
    "99": "Outros Diversos",
}
PENDENCY_STATUS = {
    "0": "0 - pendente",
    "1": "1 - contestado",
    "2": "2 - resolvido",
    "3": "3 - acao fiscal",
    "4": "4 - pendente indeferido",
    "5": "5 - deferido",
    "6": "6 - notificado",
    "7": "7 - deferido automaticamente",
    "8": "8 - aguardando autorizacao",
    "9": "9 - cancelado",
    "11": "11 - inapta - 5 anos",
    "12": "12 - pre-fiscalizacao",
}
LAUNCH_STATUS = {
    "00": "PAGO",
    "03": "PAGO",
    "28": "BAIXA DE ACORDO COM O DEC 11430/2004",
    "68": "SUSPENSO",
    "13": "CORREÇÃO NO PAGAMENTO ORIGINAL",
    "02": "PAGO A MENOR",
    "05": "PARCELADO",
    "08": "INSCRITO EM DA",
    "10": "BAIXA PROVISÓRIA",
    "14": "LANÇAMENTO EXCLUÍDO",
    "32": "COMPENSAÇÃO",
    "38": "LIQUIDAÇÃO DESVINCULADA DE CONTA GRÁFICA",
    "46": "SUSPENSÃO JUDICIAL",
    "50": "LANÇAMENTO INDEVIDO",
}
PROFILE = {"A": "Perfil A", "B": "Perfil B", "C": "Perfil C"}
ACTIVITY = {"0": "0 – Industrial ou equiparado a industrial", "1": "1 – Outros."}
PHYSICAL_MOVEMENT = {"0": "Mov. Física SIM", "1": "Mov. Física NÃO"}
TRANSPORT_PAYER = {"0": "Remetente", "1": "Expedidor", "2": "Recebedor", "3": "Destinatário"}
OMITTED_MODEL = {"55": "Saída Omissa - NF-e", "65": "Saída Omissa - NFC-e"}

UNKNOWN_CODE = "Código desconhecido"


def decode(code: Column, labels: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Label of a code; codes outside the table take ``default`` (null if none)."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.items())])
    label = F.try_element_at(table, code.cast("string"))
    if default is None:
        return label
    return F.coalesce(label, default if isinstance(default, Column) else F.lit(default))


def decode_sql(code: str, labels: Mapping[str, str], default: str = "NULL") -> str:
    """The same lookup as a standard SQL ``CASE``, for the checks."""
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in labels.items())
    return f"CASE CAST({code} AS VARCHAR) {arms} ELSE {default} END"
