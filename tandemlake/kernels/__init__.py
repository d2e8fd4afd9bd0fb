"""Numpy kernels without Spark: alignment, primer matching, mixture fitting, multiple alignment, denoising."""
