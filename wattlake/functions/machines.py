"""Machine types: one name for each of the spellings in the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.functions.scalars import col, label_or, replaced

UNKNOWN = "DESCONHECIDO"
# Spellings of each machine type that occur in the data.
SPELLINGS = {
    "SPLIT HI-WALL": ["split-wall", "split wall", "Hi-Wall", "Spli Hi-Wall", "Split", "Split Hi-Wall", "Split Hi0wall", "Split Hiwall", "Split-Wall", "SplitWall", "Splt Hi-Wall", "tipo-split-hi-wall"],
    "SPLITÃO INVERTER": ["splitao-inverter", "Spitão-Inverter", "Splitão-Inverter"],
    "SPLITÃO": ["splitao"],
    "SPLITÃO ROOFTOP": ["rooftop", "Rooftop"],
    "AR CONDICIONADO DE JANELA (ACJ)": ["ar condicionado de janela", "Acj", "ACJ (ar condicionado de janela)", "ACJ (Ar condicionado Janela)"],
    "SPLIT DUTO": ["split-duto", "Split-Duto", "SplitDuto", "tipo-split duto"],
    "SPLITÃO SELF CONTAINED": ["self", "Self", "Self Containde", "Self Contaneid", "Self-Contained"],
    "SPLITÃO SELF CONTAINED ÁGUA": ["Self Condensação A Água"],
    "SPLIT PISO-TETO": ["split-piso-teto", "split piso teto", "piso-teto", "Piso-Teto Embutido", "Split-Piso Teto", "tipo-split-piso-teto", "tipo-split-teto"],
    "SPLIT CASSETE": ["split-cassete", "split cassete", "Cassete", "Spli K7", "Spli Tipo K7", "Split K7", "Split Kassete", "Split Tipo K7", "Split-Cassete", "tipo-split-cassete"],
    "CÂMARA FRIA": ["Câmara Fria"],
    "CHILLER ÁGUA": ["Chiller-Água"],
    "CHILLER AR": ["Chiller-Ar"],
    "COLD HEAD": ["Cold Head"],
    "CORTINA DE AR": ["Cortina de ar"],
    "FANCOIL": ["Fan Coil", "Fancoil", "Fancolete"],
    "MULTISPLIT": ["Multisplit"],
    "TROCADOR DE CALOR": ["TROCADOR", "Trocador de Calor"],
    "VAV": ["VAV"],
}


def machine_type(c: Column | str, fold_keys: bool = True) -> Column:
    """The type's one name; spellings that aren't known stay in lower case, null and blank are unknown.

    With *fold_keys* spellings are matched whatever their case; without it only those that are
    in lower case already match, as in data that was prepared so.
    """
    names = {s.lower() if fold_keys else s: name for name, spellings in SPELLINGS.items() for s in spellings}
    return label_or(replaced(F.lower(F.trim(col(c))), names), UNKNOWN)
