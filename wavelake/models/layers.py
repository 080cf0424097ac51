"""Layers in numpy for injected weights: what a model server would run, at the size of a check."""

from __future__ import annotations

import math

import numpy as np

from ..functions.vectors import erf


def rms_norm(x: np.ndarray, weight: np.ndarray | None = None, eps: float = 1e-5) -> np.ndarray:
    out = x / np.sqrt((x * x).mean(-1, keepdims=True) + eps)
    return out if weight is None else out * weight


def silu(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.exp(-x))


def gelu(x: np.ndarray) -> np.ndarray:
    return 0.5 * x * (1 + erf(x / math.sqrt(2)))


def swiglu(x: np.ndarray, gate: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    return (silu(x @ gate.T) * (x @ up.T)) @ down.T


def split_heads(x: np.ndarray, heads: int) -> np.ndarray:
    """(time, channels) to (heads, time, width); channel c belongs to head c % heads, so heads are strided."""
    return x.reshape(len(x), -1, heads).transpose(2, 0, 1)


def join_heads(x: np.ndarray) -> np.ndarray:
    return x.transpose(1, 2, 0).reshape(x.shape[1], -1)


def attention(q: np.ndarray, k: np.ndarray, v: np.ndarray, heads: int, key_mask: np.ndarray | None = None) -> np.ndarray:
    """Scaled dot products over all keys that the mask lets through; a query with none gets zeros."""
    q, k, v = (split_heads(x, heads) for x in (q, k, v))
    score = q @ k.transpose(0, 2, 1) / math.sqrt(q.shape[-1])
    if key_mask is not None:
        score = np.where(key_mask[None, None, :], score, -np.inf)
    top = score.max(-1, keepdims=True)
    weight = np.exp(score - np.where(np.isfinite(top), top, 0))
    total = weight.sum(-1, keepdims=True)
    return join_heads(weight / np.where(total > 0, total, 1) @ v)


def rates(width: int, theta: float = 10000.0, stretch: float = 1.0, low: float = 1.0, high: float = 32.0, span: float = 8192.0) -> np.ndarray:
    """Angles by position of each pair. With ``stretch`` over 1, rates that turn less than ``low`` times in ``span`` positions are slowed by it,
    those that turn more than ``high`` times are not, and those between are mixed in proportion."""
    rate = theta ** (-np.arange(0, width, 2) / width)
    if stretch == 1.0:
        return rate
    turns = span * rate / (2 * math.pi)
    keep = np.clip((turns - low) / (high - low), 0, 1)
    return rate * (keep + (1 - keep) / stretch)


def rotate(x: np.ndarray, theta: float = 10000.0, stretch: float = 1.0) -> np.ndarray:
    """Rotary positions over (time, channels), neighbours paired."""
    angle = np.arange(len(x))[:, None] * rates(x.shape[1], theta, stretch)
    even, odd = x[:, 0::2], x[:, 1::2]
    out = np.empty_like(x)
    out[:, 0::2] = even * np.cos(angle) - odd * np.sin(angle)
    out[:, 1::2] = even * np.sin(angle) + odd * np.cos(angle)
    return out


def convolve(x: np.ndarray, kernel: np.ndarray, stride: int = 1) -> np.ndarray:
    """(time, in) with kernel (out, in, width); zeros on the right let each item count, on the left all but a stride of the width."""
    width = kernel.shape[2]
    left = width - stride
    frames = -(-len(x) // stride)
    padded = np.pad(x, ((left, frames * stride - len(x)), (0, 0)))
    windows = np.stack([padded[k * stride : k * stride + width] for k in range(frames)])
    return np.einsum("twi,oiw->to", windows, kernel)


def context(x: np.ndarray, gate: np.ndarray, up: np.ndarray, down: np.ndarray, norm: np.ndarray | None = None) -> np.ndarray:
    """Text or other states brought to a block's width by a gated projection, after a norm if its weight is given."""
    return swiglu(x if norm is None else rms_norm(x, norm), gate, up, down)


def whole_norm(x: np.ndarray, weight: np.ndarray, bias: np.ndarray, eps: float = 1e-5) -> np.ndarray:
    """One group: mean and spread over all times and channels, then a scale and shift for each channel."""
    return (x - x.mean()) / np.sqrt(x.var() + eps) * weight + bias


def centred(x: np.ndarray, kernel: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """(time, in) with kernel (out, in, width) at stride 1: zeros on both sides, on the left one more where they differ."""
    width = kernel.shape[2]
    right = (width - 1) // 2
    padded = np.pad(x, ((width - 1 - right, right), (0, 0)))
    windows = np.stack([padded[k : k + width] for k in range(len(x))])
    return np.einsum("twi,oiw->to", windows, kernel) + bias


def patch(x: np.ndarray, w: dict[str, np.ndarray], size: int) -> np.ndarray:
    """Residual patcher: two normed convolutions beside a shortcut of width one, then ``size`` times in one, channel by channel."""
    y = centred(silu(whole_norm(x, w["norm1"], w["norm1_bias"])), w["conv1"], w["conv1_bias"])
    y = centred(silu(whole_norm(y, w["norm2"], w["norm2_bias"])), w["conv2"], w["conv2_bias"])
    y = y + (x @ w["skip"].T + w["skip_bias"] if "skip" in w else x)
    return y.reshape(len(y) // size, size, -1).transpose(0, 2, 1).reshape(len(y) // size, -1)


def block(x: np.ndarray, context: np.ndarray, w: dict[str, np.ndarray], heads: int, context_mask: np.ndarray | None = None) -> np.ndarray:
    """A transformer block with scale, shift and gate for each part: attention, attention to the context, feed-forward."""
    s = w["modulation"].reshape(6, -1)
    y = rms_norm(x) * (1 + s[1]) + s[0]
    x = x + s[2] * (attention(rotate(y @ w["q"].T), rotate(y @ w["k"].T), y @ w["v"].T, heads) @ w["o"].T)
    x = x + attention(rms_norm(x) @ w["cq"].T, context @ w["ck"].T, context @ w["cv"].T, heads, context_mask) @ w["co"].T
    y = rms_norm(x) * (1 + s[4]) + s[3]
    return x + s[5] * swiglu(y, w["gate"], w["up"], w["down"])


def pooled_text(hidden: list[np.ndarray], layer: int) -> np.ndarray:
    """First token of one layer's states."""
    return hidden[layer][0]


def judge_scores(frames: np.ndarray, mask: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Four scores: mean over unmasked frames, scaled back."""
    return frames[mask].mean(0) * std + mean
