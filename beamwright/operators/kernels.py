"""Small numpy helpers that run inside grouped tasks: one matrix in, one out."""

import numpy as np

from beamwright.fixed import DB5


# -------------------------------------------------------------------- outliers
def _windows(a: np.ndarray, sizes: tuple, mode: str) -> np.ndarray:
    pads = [(s // 2, s - s // 2 - 1) for s in sizes]
    view = np.lib.stride_tricks.sliding_window_view(np.pad(a, pads, mode=mode), sizes)
    return view.reshape(*a.shape, -1)


def rank_middle(a: np.ndarray, sizes: tuple, mode: str) -> np.ndarray:
    """The middle ranked value of each neighbourhood."""
    w = _windows(a, sizes, mode)
    mid = w.shape[-1] // 2
    return np.partition(w, mid, axis=-1)[..., mid]


def despike_angles(sino: np.ndarray, dif: float, size: int) -> np.ndarray:
    med = rank_middle(sino, (size, 1), "reflect")
    return np.where(np.abs(sino - med) >= dif, med, sino)


def despike_image(img: np.ndarray, dif: float, size: int) -> np.ndarray:
    med = rank_middle(img, (size, size), "symmetric")
    return np.where(img - med >= dif, med, img)


# ------------------------------------------------------------------ resampling
def bilinear(img: np.ndarray, y: np.ndarray, x: np.ndarray, outside: float | None = None) -> np.ndarray:
    """Bilinear samples; beyond the border the edge pixel, or a constant."""
    h, w = img.shape
    yc, xc = (y, x) if outside is not None else (np.clip(y, 0, h - 1), np.clip(x, 0, w - 1))
    y0, x0 = np.floor(yc).astype(int), np.floor(xc).astype(int)
    fy, fx = yc - y0, xc - x0

    def pick(r, c):
        v = img[np.clip(r, 0, h - 1), np.clip(c, 0, w - 1)]
        if outside is None:
            return v
        return np.where((r >= 0) & (r < h) & (c >= 0) & (c < w), v, outside)

    top = pick(y0, x0) * (1 - fx) + pick(y0, x0 + 1) * fx
    low = pick(y0 + 1, x0) * (1 - fx) + pick(y0 + 1, x0 + 1) * fx
    return top * (1 - fy) + low * fy


def rotate(img: np.ndarray, degrees: float, cy: float, cx: float) -> np.ndarray:
    a = np.deg2rad(degrees)
    y, x = np.indices(img.shape, dtype="f8")
    dy, dx = y - cy, x - cx
    return bilinear(img, cy + np.sin(a) * dx + np.cos(a) * dy, cx + np.cos(a) * dx - np.sin(a) * dy)


def undistort(img: np.ndarray, cx: float, cy: float, factors: tuple) -> np.ndarray:
    """Radial polynomial model: distance from the centre scaled by Σ aᵢ rⁱ."""
    y, x = np.indices(img.shape, dtype="f8")
    r = np.hypot(x - cx, y - cy)
    k = np.polynomial.polynomial.polyval(r, factors)
    return bilinear(img, cy + k * (y - cy), cx + k * (x - cx))


def slide(img: np.ndarray, dx: float, dy: float) -> np.ndarray:
    """Sub-pixel shift right by dx and up by dy, zeros coming in."""
    y, x = np.indices(img.shape, dtype="f8")
    return bilinear(img, y + dy, x - dx, outside=0.0)


# ----------------------------------------------------------------------- phase
def paganin(img: np.ndarray, pixel_cm: float, distance: float, kev: float, alpha: float) -> np.ndarray:
    """Single-distance phase retrieval as a low-pass filter on the padded image."""
    wavelength = 1.23984198e-7 / kev  # cm
    shape = [1 << int(np.ceil(np.log2(2 * n))) for n in img.shape]
    pads = [((s - n) // 2, s - n - (s - n) // 2) for s, n in zip(shape, img.shape)]
    padded = np.pad(img, pads, mode="edge")
    fy, fx = np.fft.fftfreq(shape[0], pixel_cm), np.fft.rfftfreq(shape[1], pixel_cm)
    w2 = fy[:, None] ** 2 + fx[None, :] ** 2
    keep = alpha / (alpha + wavelength * distance * w2 / (4 * np.pi))
    out = np.fft.irfft2(np.fft.rfft2(padded) * keep, s=shape)
    return out[pads[0][0]:pads[0][0] + img.shape[0], pads[1][0]:pads[1][0] + img.shape[1]]


# --------------------------------------------------------------------- stripes
def _analysis(a: np.ndarray, axis: int) -> tuple:
    """One level of the periodic wavelet transform along an axis."""
    lo = np.array(DB5)
    hi = lo[::-1] * np.where(np.arange(len(lo)) % 2, -1, 1)
    a = np.moveaxis(a, axis, 0)
    n = len(a)
    at = (2 * np.arange(n // 2)[:, None] + np.arange(len(lo))) % n
    taps = a[at]
    low, high = np.tensordot(lo, taps, (0, 1)), np.tensordot(hi, taps, (0, 1))
    return np.moveaxis(low, 0, axis), np.moveaxis(high, 0, axis)


def _synthesis(low: np.ndarray, high: np.ndarray, axis: int) -> np.ndarray:
    lo = np.array(DB5)
    hi = lo[::-1] * np.where(np.arange(len(lo)) % 2, -1, 1)
    low, high = np.moveaxis(low, axis, 0), np.moveaxis(high, axis, 0)
    n = 2 * len(low)
    out = np.zeros((n, *low.shape[1:]))
    base = 2 * np.arange(len(low))
    for k, (a, b) in enumerate(zip(lo, hi)):
        out[(base + k) % n] += a * low + b * high
    return np.moveaxis(out, 0, axis)


def damp_stripes(sino: np.ndarray, sigma: float, level: int) -> np.ndarray:
    """Wavelet bands that hold stripes lose their slow change along the angle."""
    if level < 1:
        raise ValueError("level must be at least 1")
    # small sinograms are padded to the size that so many halvings need
    depth, block = level, 1 << level
    margin = [n // 16 for n in sino.shape]
    pads = [(m, m + (-(n + 2 * m)) % block) for n, m in zip(sino.shape, margin)]
    low, bands = np.pad(sino, pads, mode="symmetric"), []
    for _ in range(depth):
        left, right = _analysis(low, 1)
        low, across = _analysis(left, 0)
        stripes, mixed = _analysis(right, 0)
        n = len(stripes)
        f = np.fft.fftfreq(n) * n
        keep = 1 - np.exp(-(f**2) / (2 * sigma**2))
        stripes = np.fft.ifft(np.fft.fft(stripes, axis=0) * keep[:, None], axis=0).real
        bands.append((across, stripes, mixed))
    for across, stripes, mixed in reversed(bands):
        low = _synthesis(_synthesis(low, across, 0), _synthesis(stripes, mixed, 0), 1)
    return low[margin[0]:margin[0] + sino.shape[0], margin[1]:margin[1] + sino.shape[1]]


def ring_profile(mean: np.ndarray, alpha: float, order: int) -> np.ndarray:
    """Offsets q that flatten the mean profile: (DᵀD + α²) q = −DᵀD·mean."""
    d = np.diff(np.eye(len(mean)), n=order, axis=0)
    m = d.T @ d
    return np.linalg.solve(m + alpha**2 * np.eye(len(mean)), -m @ mean)


def flatten_profile(sino: np.ndarray, nblock: int, alpha: float) -> np.ndarray:
    """First and second order offsets per block of angles, joined by a geometric mean."""
    if nblock > len(sino):
        raise ValueError(f"{nblock} blocks of {len(sino)} angles")
    edges = np.linspace(0, len(sino), max(1, nblock) + 1).astype(int)
    product = np.empty_like(sino)
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = sino[lo:hi]
        totals = part.sum(axis=1)
        weight = min(1 / max(2 * np.ptp(totals), 1e-12), 1e6)
        mean = part.mean(axis=0)
        product[lo:hi] = (part + ring_profile(mean, weight, 1)) * (part + ring_profile(mean, weight, 2))
    return np.sqrt(np.maximum(product + alpha * abs(product.min()), 0))


def smooth_stripes(sino: np.ndarray, size: int) -> np.ndarray:
    mean = sino.mean(axis=0)
    padded = np.pad(mean, (size // 2, size - size // 2 - 1), mode="edge")
    return sino - (mean - np.convolve(padded, np.full(size, 1 / size), "valid"))


# -------------------------------------------------------------- reconstruction
def ramp(nfft: int, cutoff: float, order: float) -> np.ndarray:
    f = np.fft.rfftfreq(nfft)
    return f / (1 + (f / cutoff) ** (2 * order))


def back_project(rays, theta, weight, size, center, cutoff, order) -> np.ndarray:
    """Filtered back-projection of some angles onto a square image."""
    nfft = 1 << int(np.ceil(np.log2(2 * rays.shape[1])))
    q = np.fft.irfft(np.fft.rfft(rays, nfft, axis=1) * ramp(nfft, cutoff, order), nfft, axis=1)[:, : rays.shape[1]]
    c, last = np.arange(size) - (size - 1) / 2, rays.shape[1] - 1
    img = np.zeros((size, size))
    for row, a, w in zip(q, theta, weight):
        t = c[None, :] * np.cos(a) + c[:, None] * np.sin(a) + center
        i = np.clip(t.astype(int), 0, last - 1)
        f = t - i
        img += np.where((t >= 0) & (t <= last), w * (row[i] * (1 - f) + row[i + 1] * f), 0.0)
    return img


def fast_length(n: int) -> int:
    """The next even length with no prime factor above 5."""
    n += n % 2
    while True:
        rest = n
        for p in (2, 3, 5):
            while rest % p == 0:
                rest //= p
        if rest == 1:
            return n
        n += 2


def grid_project(rays, theta, weight, size, center, cutoff, order, width: int = 4, block: int = 1 << 18) -> np.ndarray:
    """The same sum done in Fourier space: samples spread on a grid, one inverse FFT.

    Real input needs positive frequencies only; zero frequency has no weight.
    """
    nfft, m = fast_length(2 * rays.shape[1] + size), fast_length(2 * size)
    f = np.fft.rfftfreq(nfft)[1:]
    gain = ramp(nfft, cutoff, order)[1:] * 2 / nfft
    gain[-1] /= 2  # the highest frequency stands for itself only
    half = size // 2 - (size - 1) / 2
    beta = np.pi * np.sqrt((width / 2) ** 2 * 1.5**2 - 0.8)
    fine = 1 << 13  # table entries per grid step
    at_bell = np.arange(width * fine // 2 + 2) / fine
    table = np.i0(beta * np.sqrt(np.clip(1 - (2 * at_bell / width) ** 2, 0, None)))

    def bell(d):
        return table[(np.abs(d) * fine + 0.5).astype(int)]

    real, imag = np.zeros(m * m), np.zeros(m * m)
    step = max(1, block // len(f))
    for lo in range(0, len(rays), step):
        part, a = rays[lo:lo + step], np.asarray(theta)[lo:lo + step, None]
        fx, fy = np.cos(a) * f, np.sin(a) * f
        spec = np.fft.rfft(part, nfft, axis=1)[:, 1:] * gain * np.asarray(weight)[lo:lo + step, None]
        spec *= np.exp(2j * np.pi * (f * center + (fx + fy) * half))
        u, v, s = (fx * m).ravel(), (fy * m).ravel(), spec.ravel()
        u0, v0 = np.ceil(u - width / 2).astype(int), np.ceil(v - width / 2).astype(int)
        across = [bell(u0 + i - u) for i in range(width)]
        for j in range(width):
            line = s * bell(v0 + j - v)
            row = ((v0 + j) % m) * m
            for i in range(width):
                at, value = row + (u0 + i) % m, line * across[i]
                np.add.at(real, at, value.real)
                np.add.at(imag, at, value.imag)
    pos = np.arange(size) - size // 2
    img = np.fft.ifft2((real + 1j * imag).reshape(m, m)).real * m * m
    z = np.sqrt((beta**2 - (np.pi * width * pos / m) ** 2).astype(complex))
    bump = (width * np.sinh(z) / z).real
    return img[np.ix_(pos % m, pos % m)] / bump[:, None] / bump[None, :]


def polar_smooth(img: np.ndarray, arc: float, width: int, high: float, limit: float, low: float) -> np.ndarray:
    """Rings as the radial departure from a running median, averaged over an arc."""
    n = img.shape[0]
    c, radii = (n - 1) / 2, np.arange(n // 2)
    angles = np.deg2rad(np.arange(0, 360, 360 / max(8, 4 * len(radii))))
    polar = bilinear(img, c + radii[:, None] * np.sin(angles), c + radii[:, None] * np.cos(angles))
    clipped = np.clip(polar, low, high)
    size = 2 * (max(1, width) // 2) + 1
    ring = clipped - rank_middle(clipped, (size, 1), "symmetric")
    ring[np.abs(ring) > limit] = 0
    span = max(1, int(round(arc / 360 * len(angles))))
    sums = np.cumsum(np.concatenate([np.zeros((len(radii), 1)), np.tile(ring, 2)], axis=1), axis=1)
    mean = (sums[:, span:span + len(angles)] - sums[:, : len(angles)]) / span
    mean = np.roll(mean, span // 2, axis=1)
    y, x = np.indices(img.shape) - c
    r, a = np.hypot(x, y), np.mod(np.arctan2(y, x), 2 * np.pi) / (2 * np.pi) * len(angles)
    back = bilinear(np.concatenate([mean, mean[:, :1]], axis=1), r, a)
    return img - np.where(r < len(radii), back, 0.0)


# --------------------------------------------------------------------- centres
def register(a: np.ndarray, b: np.ndarray, upsample: int) -> float:
    """Horizontal shift of b against a by phase correlation, refined around the peak."""
    cross = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    cross /= np.maximum(np.abs(cross), np.finfo("f8").eps * 100)
    peak = np.unravel_index(np.argmax(np.abs(np.fft.ifft2(cross))), a.shape)
    shift = np.array([p - n if p > n // 2 else p for p, n in zip(peak, a.shape)], dtype="f8")
    if upsample > 1:
        span = np.arange(-int(np.ceil(0.75 * upsample)), int(np.ceil(0.75 * upsample)) + 1) / upsample
        fine = [
            np.exp(2j * np.pi * np.outer(s + span, np.fft.fftfreq(n))) for s, n in zip(shift, a.shape)
        ]
        best = np.abs(fine[0] @ cross @ fine[1].T)
        shift += span[np.array(np.unravel_index(np.argmax(best), best.shape))]
    return float(shift[1])


def mirror_scores(sino: np.ndarray, centers: np.ndarray, ratio: float, drop: int) -> np.ndarray | None:
    """For each centre: Fourier energy outside the double wedge of the full-turn sinogram.

    None if the sinogram has so few projections that ``drop`` leaves no frequency to tell centres apart.
    """
    n, w = sino.shape
    flipped = sino[1:, ::-1]
    rows = 2 * n - 1
    # outside the wedge |v| > ratio·π·|u|·w/2 a true full turn has almost no energy
    v = np.abs(np.fft.fftfreq(rows) * rows)[:, None]
    u = np.abs(np.fft.rfftfreq(w))[None, :]
    if drop >= rows // 2:
        return None
    mask = (v > ratio * np.pi * w * u) & (v > drop)
    scores = []
    for c in centers:
        by = 2 * c - (w - 1)
        x = np.arange(w) - by
        x0 = np.floor(x).astype(int)
        f = x - x0
        ok = (x0 >= 0) & (x0 + 1 < w)
        left, right = np.clip(x0, 0, w - 1), np.clip(x0 + 1, 0, w - 1)
        moved = flipped[:, left] * (1 - f) + flipped[:, right] * f
        moved = np.where(ok, moved, sino[1:] if n > 1 else moved)
        full = np.concatenate([sino, moved])
        scores.append(np.mean(np.abs(np.fft.rfft2(full)) * mask))
    return np.array(scores)


def entropy(img: np.ndarray, low: float, high: float, ratio: float, masked: bool, bins: int = 64) -> float:
    """Entropy of the histogram of a slice inside its circle."""
    n = img.shape[0]
    y, x = np.indices(img.shape) - (n - 1) / 2
    inside = np.hypot(x, y) < ratio * n / 2 if masked else np.ones(img.shape, bool)
    h, _ = np.histogram(img[inside], bins=bins, range=(low, high))
    p = h[h > 0] / max(h.sum(), 1)
    return float(-(p * np.log2(p)).sum())
