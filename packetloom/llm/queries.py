"""The query modules of this subpackage."""

from packetloom.llm import q_canonical, q_ocr, q_overlap, q_packing, q_residue, q_survivors, q_variants

MODULES = [q_canonical, q_variants, q_survivors, q_overlap, q_ocr, q_packing, q_residue]
