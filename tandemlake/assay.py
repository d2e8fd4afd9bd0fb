"""The assay: reference amplicon, primers, coordinates, and the settings of a run."""

from __future__ import annotations

from dataclasses import dataclass

from tandemlake.kernels.denoise import Denoiser

# Public human-genome sequence (plus strand) and the assay's primers.
WT = (
    "CTGTACCTTTCAGCATTTTGACGGCAACCTGGATTGAGACTCCTGTTTTGCTAATTCCATAAGCTGTTGCGTTCATCACTTTTC"
    "CAAAAGCACCTGATCCTAGTACCTTCCCTGCAAAGACAAATGGTGAGTACGTGCATTTTAAAGATTTTCCAATGGAAAAGAAAT"
    "GCTGCAGAAACATTTGGCACATTCCATTCTTACCAAACTCTAAATTTTCTCTTGGAAACTCCCATTTGAGATCATATTCATATT"
    "CTCTGAAATCAACGTAGAAGTACTCATTATCTGAGGAGCCGGTCACCTGTACCATCTGTAGCTGGCTTTCATACCTAAATTGCT"
)
FORWARD_PRIMER = "AGCAATTTAGGTATGAAAGCCAGC"
REVERSE_PRIMER = "CTGTACCTTTCAGCATTTTGACG"
#: Amplicon and extraction window (first and last base, 1-based) on chromosome 13, by genome build.
AMPLICON = {"hg38": (28033881, 28034216), "hg19": (28608018, 28608353)}
EXTRACTION = {"hg38": (28033301, 28034800), "hg19": (28607438, 28608937)}
# First and last base of the gene's exons on chromosome 13 of hg38, by position.
EXONS_HG38 = [
    (28003273, 28004174), (28014451, 28014557), (28015156, 28015256), (28015589, 28015701), (28018466, 28018589), (28023349, 28023477), (28024860, 28024943), (28027087, 28027241),
    (28028177, 28028288), (28033886, 28033991), (28034081, 28034214), (28034300, 28034407), (28035494, 28035673), (28035934, 28036043), (28037184, 28037288), (28048274, 28048443),
    (28049383, 28049537), (28049634, 28049774), (28050094, 28050222), (28052544, 28052674), (28057346, 28057462), (28061866, 28062069), (28070490, 28070612), (28100467, 28100576),
]


def exons(genome: str) -> list[tuple[str, int, int]]:
    """Label, first and last base of each exon by position. The gene is read from the minus strand, so the last is exon 1; in
    hg19 all stand as far off as the amplicon does."""
    shift = AMPLICON["hg38" if genome == "hg38" else "hg19"][0] - AMPLICON["hg38"][0]
    return [(f"Ex{len(EXONS_HG38) - i}", a + shift, b + shift) for i, (a, b) in enumerate(EXONS_HG38)]


def reverse_complement(seq: str) -> str:
    return seq.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]


def resolve_contig(names: list[str]) -> str:
    """The header's name of chromosome 13."""
    for name in ("chr13", "13"):
        if name in names:
            return name
    raise ValueError("the header has neither chr13 nor 13")


@dataclass(frozen=True)
class Settings:
    """Command-line parameters of a run, with their defaults."""

    genome: str = "hg38"
    min_allele_frequency: float = 0.05
    min_mapping_quality: int = 20
    min_read_length: int = 330
    wt_amplicon_length: int = 336
    wt_peak_tolerance: float = 5.0
    assign_mode: str = "manual"
    prob_threshold: float = 0.85
    max_itd_size: int = 300
    min_itd_size: int = 12
    observed_rescue: bool = True
    min_observed_reads: int = 20
    anchor_length: int = 20
    anchor_shift: int = 10
    anchor_max_mismatches: int = 3
    max_itds: int = 6
    min_gmm_fraction: float = 0.01
    min_gmm_peak_distance: float = 10.0
    max_peak_sd: float = 5.0
    force_k: int | None = None
    haplotype_method: str = "denoise"
    cluster_wt_peak: bool = False
    min_haplotype_reads: int = 20
    omega_a: float = 1e-40
    band_size: int = 32
    homopolymer_gap_penalty: int = -1
    singleton_centres: bool = True
    min_subpeak_fraction: float = 0.15
    subpeak_refinement: bool = True
    msa_max_unique: int = 150
    msa_min_weight_coverage: float = 0.98
    msa_base_threshold: float = 0.7
    msa_min_col_coverage: float = 0.7
    validate_peak_reads_only: bool = False
    assign_width_factor: float = 2.0
    itd_sd_factor: float = 1.5

    def __post_init__(self) -> None:
        if not 0 <= self.wt_peak_tolerance < self.min_itd_size:
            raise ValueError("wt_peak_tolerance must be at least 0 and below min_itd_size")
        if self.min_observed_reads < 3:
            raise ValueError("min_observed_reads must be at least 3")
        if not 0 <= self.anchor_max_mismatches < self.anchor_length:
            raise ValueError("anchor_max_mismatches must be at least 0 and below anchor_length")
        anchor_coordinates(self.wt_amplicon_length, self.anchor_length, self.anchor_shift)

    @property
    def denoiser(self) -> Denoiser:
        return Denoiser(self.omega_a, self.band_size, self.homopolymer_gap_penalty, self.singleton_centres, least_reads=self.min_haplotype_reads, least_share=self.min_subpeak_fraction)

    @property
    def max_read_length(self) -> int:
        return self.wt_amplicon_length + int(self.max_itd_size * 1.1)


def anchor_coordinates(ref_length: int, anchor_length: int = 20, anchor_shift: int = 10) -> tuple[int, int]:
    """Outer bounds [start, stop) of the window between the anchors; a shift moves both towards the ends."""
    start, stop = 25 - anchor_shift, ref_length - 21 + anchor_shift
    if anchor_length < 1:
        raise ValueError("anchor_length must be positive")
    if anchor_shift < 0 or start < 0 or stop > ref_length:
        raise ValueError("shifted anchors must stay inside the reference")
    if stop - start <= 2 * anchor_length:
        raise ValueError("no interior is left between the anchors")
    return start, stop
