"""Fixed schemas of the tables between stages; column names are snake case inside."""

from __future__ import annotations

from .config import DATABASES, SCORED

SEQUENCES = "source_file string, is_vmag boolean, genome string, name string, description string, seq string"
GENE_INDEX = "genome string, contig string, protein string, gene_number long, contig_pos_start long, contig_pos_end long, frame int, is_vmag boolean"
CIRCULAR = (
    "contig string, contig_length long, kmer_freq double, prediction_type string, repeat_length long, repeat_count long,"
    " repeat_n_freq double, repeat_mode_base_freq double, repeat_seq string, flagged boolean, reason string"
)
CIRCULAR_COLUMNS = [x.split()[0] for x in CIRCULAR.split(",")[:9]]
HITS_RAW = "db string, sequence string, hmm_id string, evalue double, score double, length long, start long, end long"
HITS_BEST = "db string, sequence string, hmm_id string, score double, hmm_coverage double"
THRESHOLDS = "db string, hmm_id string, value double"
VSCORES = "id string, v_score double, vl_score double, db string, name string"
DESCRIPTIONS = "id string, db string, name string"
CLASS_LIST = "id string, v_score float, vl_score float, db string, name string"
ID_SET = "id string"
KEYWORDS = "substring string, type string"

#: Display names of the annotation table's columns, in order.
ANNOTATION_COLUMNS = {
    "protein": "Protein", "contig": "Contig", "genome": "Genome",
    **{f"{db.lower()}_v_score": f"{db}_V-score" for db in SCORED},
    **{f"{db.lower()}_{c}": f"{db}_{title}" for db in DATABASES for c, title in (("hmm_id", "hmm_id"), ("description", "Description"), ("score", "score"), ("coverage", "coverage"))},
    "top_hit_hmm_id": "top_hit_hmm_id", "top_hit_description": "top_hit_description", "top_hit_db": "top_hit_db",
    "circular_contig": "Circular_Contig", "viral_origin_confidence": "Viral_Origin_Confidence",
    "viral_flanking_up": "Viral_Flanking_Genes_Upstream", "viral_flanking_down": "Viral_Flanking_Genes_Downstream",
    "mge_flanking": "MGE_Flanking_Genes",
}

# What output files call a class: its sequence folder, its table, its proteins.
OUTPUT_NAMES = {"metabolic": ("metabolic", "metabolic", "AMGs"), "physiological": ("physiology", "physiology", "APGs"), "regulatory": ("regulatory", "regulation", "AReGs")}

#: Display names of the final table's columns, in order.
FINAL_COLUMNS = {
    "protein": "Protein", "contig": "Contig", "genome": "Genome",
    "classification": "Protein Classification", "viral_origin_confidence": "Protein Viral Origin Confidence",
    "kegg_hmm_id": "KEGG KO", "kegg_description": "KEGG KO Name",
    "foam_hmm_id": "FOAM ID", "foam_description": "FOAM Annotation",
    "pfam_hmm_id": "Pfam Accession", "pfam_description": "Pfam Name",
    "dbcan_hmm_id": "CAZy Family", "dbcan_description": "CAZy Activities",
    "metabolic_hmm_id": "METABOLIC db ID", "metabolic_description": "METABOLIC Annotation",
    "phrog_hmm_id": "PHROG Number", "phrog_description": "PHROG Annotation",
    "top_hit_hmm_id": "Best Scoring HMM", "top_hit_description": "Best Scoring HMM Annotation", "top_hit_db": "Best Scoring HMM Origin",
}
